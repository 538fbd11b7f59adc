"""The same results in DuckDB SQL, where SQL can express them."""

from .quality import STOP_WORDS
from .line_dedup import MIN_SITES
from .sharding import BITS_PER_WORD, LIMIT_BYTES

_STOPS = ", ".join(f"'{word}'" for base in STOP_WORDS for word in (base, base.capitalize()))
_BLANK = r"[\x20\x09-\x0D]"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES = {
    "op1_quality_rules": rf"""
        with d as (
            select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
        w as (
            select rid, doc_id, t,
                   list_filter(regexp_split_to_array(t, '{_BLANK}+'), lambda x: x <> '') as ws,
                   list_filter(string_split(t, chr(10)), lambda x: trim(x, {_BLANKS}) <> '') as ls
            from d),
        places as (select rid, ws, unnest(range(1, len(ws) - 1)) as i from w),
        repeated as (
            select rid, i from places
            qualify count(*) over (partition by rid, ws[i], ws[i + 1], ws[i + 2]) > 1),
        covered as (
            select rid, count(distinct i + k) as n from repeated, (values (0), (1), (2)) as near(k) group by rid),
        counts as (
            select doc_id,
                   len(ws)::bigint as n_words,
                   length(regexp_replace(t, '{_BLANK}', '', 'g'))::bigint as word_chars,
                   len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols,
                   (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
                   coalesce(covered.n, 0)::bigint as n_repeat_words,
                   len(ls)::bigint as n_lines,
                   len(list_filter(ws, lambda x: x in ({_STOPS})))::bigint as n_stop_words,
                   len(list_filter(ws, lambda x: x = '|'))::bigint as n_bars,
                   len(list_filter(ws, lambda x: ends_with(x, '!!')))::bigint as n_shouts,
                   len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…){_BLANK}*\z')))::bigint as n_ellipsis_lines,
                   len(list_filter(ls, lambda x: regexp_matches(x, '\A{_BLANK}*[-*•]')))::bigint as n_bullet_lines
            from w left join covered using (rid)),
        judged as (
            select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
                   greatest(n_words, 1) as nw, greatest(n_lines, 1) as nl
            from counts)
        select * exclude (nw, nl),
               not base_failed and n_words >= 50 and word_chars / nw between 2 and 14
               and n_symbols / nw <= 0.25 and n_bars / nw <= 0.25 and n_shouts / nw <= 0.5
               and n_stop_words / nw >= 0.02 and n_dup_lines / nl <= 0.6
               and n_ellipsis_lines / nl <= 0.5 and n_bullet_lines / nl <= 0.95 as kept
        from judged""",
    "op7_sharding": f"""
        with d as (
            select doc_id, coalesce(strlen(text), 0)::bigint as bytes,
                   ('0x' || left(md5(coalesce(cast(doc_id as varchar), '')), {BITS_PER_WORD // 4}))::bigint as h
            from documents),
        marked as (select *, lpad(bin(h), {BITS_PER_WORD}, '0') as path from d),
        sums as (
            select depth, left(path, depth) as shard, sum(bytes)::bigint as shard_bytes, count(*) as shard_rows
            from marked, range(0, 41) as levels(depth) group by all),
        fitting as (select * from sums where shard_bytes <= {LIMIT_BYTES} or shard_rows = 1)
        select doc_id, bytes, shard, depth::int as depth, shard_bytes, shard_rows
        from marked join fitting on left(path, depth) = shard
        qualify row_number() over (partition by doc_id order by depth) = 1""",
    "op9_line_dedup": rf"""
        with d as (
            select row_number() over () as rid, doc_id, source, text, string_split(coalesce(text, ''), chr(10)) as ls
            from documents),
        lines as (
            select rid, doc_id, source, text, unnest(ls) as line, generate_subscripts(ls, 1) as pos from d),
        trimmed as (select *, trim(line, {_BLANKS}) as bare from lines),
        boilerplate as (
            select bare, min(doc_id) as first_doc from trimmed where bare <> ''
            group by bare having count(distinct source) >= {MIN_SITES}),
        marked as (
            select t.*, b.bare is not null and t.doc_id is distinct from b.first_doc as gone
            from trimmed as t left join boilerplate as b on t.bare = b.bare)
        select any_value(doc_id) as doc_id,
               case when any_value(text) is not null
                    then coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '') end as text,
               count(*) as n_lines, count(*) filter (gone) as n_removed
        from marked group by rid""",
    "op10_exact_dedup": rf"""
        with d as (
            select row_number() over () as rid, doc_id, coalesce(length(text), 0) as n,
                   regexp_replace(coalesce(text, ''), '{_BLANK}', '', 'g') as norm
            from documents)
        select doc_id, first_value(doc_id) over best as keep_id, count(*) over (partition by norm) as group_size,
               row_number() over best = 1 as kept, sha256(norm) as text_sha256
        from d window best as (partition by norm order by n desc, doc_id nulls last, rid)""",
    "op12_fill_in_middle": """
        with d as (
            select row_number() over () as rid, doc_id, coalesce(text, '') as t,
                   regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u,
                   sha256('1:' || coalesce(doc_id::varchar, '')) as h
            from documents),
        drawn as (
            select rid, doc_id, t, u, len(u) as n, ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2,
                   ('0x' || substr(h, 17, 8))::bigint as h3, ('0x' || substr(h, 25, 8))::bigint as h4
            from d),
        cuts as (
            select *, least(h1 % (n + 1), h2 % (n + 1)) as low, greatest(h1 % (n + 1), h2 % (n + 1)) as high,
                   case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
                        when h4 % 100 < 20 then 'spm' else 'psm' end as form
            from drawn),
        parts as (
            select *, array_to_string(u[1:low], '') as prefix, array_to_string(u[low + 1:high], '') as middle,
                   array_to_string(u[high + 1:n], '') as suffix
            from cuts)
        select doc_id, n::bigint as n, form,
               case when form <> 'plain' then length(prefix) end::bigint as prefix_chars,
               case when form <> 'plain' then length(middle) end::bigint as middle_chars,
               sha256(case form when 'plain' then t when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
               sha256(t) as restored_sha256
        from parts""",
}
