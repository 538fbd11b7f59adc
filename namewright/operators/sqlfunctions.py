"""The extraction as a function for SQL users."""

from pyspark.sql import SparkSession

from ..functions.declarations import DECLARATION, SNIPPET_NAME


def register_extract_classes(spark: SparkSession, name: str = "extract_classes") -> None:
    """Register ``extract_classes(content, language)``, an array of declarations for ``inline``.

    ``select path, c.* from (select path, extract_classes(content, language) as found
    from files) lateral view inline(found) c`` gives the place, text and name of each
    declaration. Spark expands it into built-in expressions, without a join. Offsets are listed
    once per file, in blocks of 256, so files may have any number of declarations.
    """

    def per_language(render) -> str:
        return " ".join(f"when '{language}' then {render(language)}" for language in DECLARATION)

    # Raw SQL strings; the patterns hold no quotes.
    marked = per_language(lambda language: f"regexp_replace(content, r'{DECLARATION[language]}', mark || r'$0')")
    target = per_language(lambda language: f"regexp_extract(snippet, r'{SNIPPET_NAME[language]}', 1)")
    # Where each piece ends; a block's sums start at the end of the block before.
    before = "coalesce(try_element_at(try_element_at(blocks, -1), -1), 0L)"
    block = f"""aggregate(slice(pieces, first, 256), cast(array() as array<bigint>), (ends, piece) ->
        concat(ends, array(coalesce(try_element_at(ends, -1), {before}) + length(piece))))"""
    ends = f"""flatten(aggregate(sequence(1, greatest(size(pieces), 1), 256), cast(array() as array<array<bigint>>),
        (blocks, first) -> concat(blocks, array({block}))))"""
    mark = "if(contains(content, chr(1)), chr(1) || sha2(content, 256) || chr(1), chr(1))"
    pieces = f"transform(array({mark}), mark -> split(case language {marked} else content end, mark, -1))"
    spark.sql(f"""
        create or replace temporary function {name}(content string, language string)
        returns array<struct<span_start bigint, span_end bigint, snippet string, target string>>
        return flatten(transform(transform({pieces}, pieces -> struct(pieces as pieces, {ends} as ends)), cut ->
          transform(slice(cut.pieces, 2, greatest(size(cut.pieces) - 1, 0)), (snippet, place) -> struct(
            get(cut.ends, place) as span_start, get(cut.ends, place) + length(snippet) as span_end, snippet as snippet,
            case language {target} end as target))))""")
