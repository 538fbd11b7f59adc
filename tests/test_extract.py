"""Extraction against hand-written cases and an independent restatement in Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from namewright.functions.declarations import mask_header
from namewright.operators.extract import extract_declarations, extract_examples, to_example_rows

# What counts as a declaration in each language, restated for comparison.
NAME = "([A-Za-z_][A-Za-z0-9_]*)"
JAVA = r"\b(?:class|interface|enum)\s+"
KINDS = r"(?:class|interface|struct|enum|record)\s+"
PATTERNS = {
    "python": re.compile(r"^class\s+" + NAME, re.M),
    "java": re.compile(JAVA + NAME + r"\b"),
    "csharp": re.compile(
        r"\b(?:public|private|internal|protected)?\s*(?:static|sealed|abstract|partial)?\s*" + KINDS + NAME + r"\b"
    ),
}
MASKED = {"python": r"(class\s+)", "java": f"({JAVA})", "csharp": rf"(\b{KINDS})"}


def restated(language, content):
    found = list(PATTERNS[language].finditer(content))
    ends = [match.start() for match in found[1:]] + [len(content)]
    rows = []
    for match, end in zip(found, ends):
        snippet, name = content[match.start() : end], match.group(1)
        edge = "" if language == "python" else r"\b"
        masked = re.sub(MASKED[language] + name + edge, r"\1____", snippet, count=1)
        rows.append((match.start(), end, name, snippet, masked))
    return rows


def files(spark, rows):
    data = [("r", f"f{i:05d}", language, content) for i, (language, content) in enumerate(rows)]
    return spark.createDataFrame(data, "repo string, path string, language string, content string")


def spans(spark, language, content):
    found = extract_declarations(files(spark, [(language, content)])).orderBy("span_start").collect()
    assert "".join(row.snippet for row in found) == (content[found[0].span_start :] if found else "")
    return [(row.target, row.span_start, row.span_end) for row in found]


@pytest.mark.parametrize(
    "language, content, expected",
    [
        ("java", "/** This class is big */", [("is", 9, 24)]),
        ("java", "public @interface Foo {}", [("Foo", 8, 24)]),
        ("java", "record R(){}", []),
        ("java", "Bar.class\n x", [("x", 4, 12)]),
        ("java", "subclass A", []),
        ("csharp", "record class Z(int a);", [("class", 0, 22)]),
        ("csharp", "// the end\nclass X {}", [("X", 10, 21)]),
        ("csharp", "public sealed partial class Y{}", [("Y", 13, 31)]),
        ("csharp", "publicclass Q", [("Q", 0, 13)]),
        ("python", "class A:\n  class B:\n", [("A", 0, 20)]),
        ("python", "x \u2028 class A \x85 class B \nclass C", [("C", 23, 30)]),
        ("python", "\u2028class A\x85class B\rclass D", []),
        ("python", "é\x01\nclass A:\n\x01class\nclass B:", [("A", 3, 19), ("B", 19, 27)]),
        ("python", "class\u00a0N:", [("N", 0, 8)]),
        ("ruby", "class A", []),
        ("python", "", []),
    ],
)
def test_spans(spark, language, content, expected):
    assert spans(spark, language, content) == expected


def test_random_texts_equal_the_restatement(spark):
    words = [
        "class", "interface", "enum", "record", "struct", "public", "private", "internal", "protected", "static",
        "sealed", "abstract", "partial", "Foo", "Bar1", "_x", "é", "e\u0301", "½", "\u2028", "\x1c", "\u00a0", " ", " ",
        " ", "\n", "\n", "\n", "\t", "(", "{", ":", ".", ";", "/*", "9", "\x01", "$1", "\\1", "____", "subclass", "",
    ]
    dice = random.Random(7)
    rows = []
    for i in range(1500):
        content = "".join(dice.choice(words) + dice.choice(["", " ", " ", "\n"]) for _ in range(dice.randrange(1, 60)))
        rows.append((["python", "java", "csharp"][i % 3], content))
    examples = extract_examples(files(spark, rows), min_lines=1)
    got = {}
    for row in examples.collect():
        got.setdefault(row.path, []).append((row.span_start, row.span_end, row.target, row.source))
    for i, (language, content) in enumerate(rows):
        want = [(start, end, name, masked) for start, end, name, _, masked in restated(language, content)]
        assert sorted(got.get(f"f{i:05d}", [])) == sorted(want), (language, content)


def test_many_declarations_in_one_file(spark):
    content = "".join(f"class K{i}:\n    pass\n\n" for i in range(3000))
    rows = extract_declarations(files(spark, [("python", content)])).orderBy("span_start").collect()
    assert [(r.span_start, r.span_end, r.target) for r in rows] == [row[:3] for row in restated("python", content)]


def test_glued_keyword_is_not_masked(spark):
    rows = extract_examples(files(spark, [("csharp", "publicclass Q {\n\n}")])).collect()
    assert [(r.target, r.source) for r in rows] == [("Q", "publicclass Q {\n\n}")]


def test_min_lines_counts_the_early_start(spark):
    data = files(spark, [("csharp", "// the end\nclass X {\n}")])
    assert extract_examples(data, min_lines=3).count() == 1
    assert extract_examples(data, min_lines=4).count() == 0


def test_only_the_declaration_is_masked(spark):
    content = "class Foo {\n  Foo() {}\n}\n"
    row = to_example_rows(extract_examples(files(spark, [("java", content)]))).first()
    assert row.source == content.replace("class Foo", "class ____")
    assert row.class_span.asDict() == {"start": 0, "end": len(content)}
    plain = extract_examples(files(spark, [("java", content)]), mask=False).first()
    assert plain.source == content


@pytest.mark.parametrize(
    "language, content, expected",
    [
        ("python", "# class Foo note\nclass Foo:", "# class ____ note\nclass Foo:"),
        ("python", "  class FooBar: ...\nclass Foo:", "  class ____Bar: ...\nclass Foo:"),
        ("python", "  class Foo:", "  class Foo:"),
        ("python", "subclass Foo\nclass Foo\nclass Bar", "subclass ____\nclass Foo\nclass Bar"),
        ("java", "x enum  E1 {}\nclass E1", "x enum  ____ {}\nclass E1"),
        ("java", "nothing", "nothing"),
        ("csharp", "class A", "class A"),
    ],
)
def test_mask_header(spark, language, content, expected):
    row = files(spark, [(language, content)]).select(mask_header(F.col("content"), F.col("language")).alias("m")).first()
    assert row.m == expected


def test_csharp_search_is_linear_in_blanks(spark):
    text = "int x;" + " " * 1_000_000 + "public class Box {\n}\n"
    files = spark.createDataFrame([("r", "a.cs", "csharp", text)], "repo string, path string, language string, content string")
    assert [r.target for r in extract_examples(files, False, 1).collect()] == ["Box"]
