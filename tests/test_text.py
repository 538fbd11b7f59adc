from pyspark.sql import functions as F

from namewright.functions import prompts, text

SPACES = [chr(code) for code in range(0x110000) if chr(code).isspace()]


def test_white_space_is_pythons(values):
    inputs = [f"{space}a{space}{space}b c{space}" for space in SPACES] + ["", " ", "\u200bx", "\ufeffy"]
    assert values(lambda x: text.trim_ws(F.col(x)), inputs) == [s.strip() for s in inputs]
    assert values(lambda x: text.first_token(F.col(x)), inputs) == [(s.split() or [""])[0] for s in inputs]
    assert values(lambda x: text.normalize_source(F.col(x)), inputs) == [" ".join(s.split()) for s in inputs]


def test_repo_slug(values):
    inputs = ["https://h/o/r.git/", "https://h/o/r", "r", "r.git", "a/b//", "git@h:o/r.git", "o/r.gitx", ""]
    expected = ["o__r", "o__r", "r", "r", "a__b", "git@h:o__r", "o__r.gitx", ""]
    assert values(lambda x: text.repo_slug(F.col(x)), inputs) == expected


def test_decode_drops_bad_bytes_and_unifies_newlines(values):
    inputs = [b"caf\xe9 \xff ok", b"a\r\nb\rc\n", "é\u2028x".encode(), b""]
    got = values(lambda x: text.decode_source(F.col(x)), [bytearray(b) for b in inputs], "binary")
    assert got == ["caf  ok", "a\nb\nc\n", "é\u2028x", ""]


def test_lines_preview_language(values):
    assert values(lambda x: text.count_lines(F.col(x)), ["", "a", "a\n", "\n\n"]) == [1, 1, 2, 3]
    long = "é" * 101
    assert values(lambda x: text.preview(F.col(x)), ["a" * 100, long]) == ["a" * 100, long[:100] + "..."]
    paths = ["a/b.py", "X.java", "p.cs", "p.css", "py", "x.PY"]
    assert values(lambda x: text.language_of(F.col(x)), paths) == ["python", "java", "csharp", None, None, None]


def test_numbers_round_like_python(values):
    shares = [0.0, 1.0, 0.12345, 1 / 3, 0.00125, 0.99995]
    assert values(lambda x: text.percent(F.col(x)), shares, "double") == [f"{s:.2%}" for s in shares]
    numbers = [0.125, 0.375, 2.675, 1.005, 1234.5]
    assert values(lambda x: text.fixed(F.col(x), 2), numbers, "double") == [f"{n:.2f}" for n in numbers]


RAW = [
    "class ____:\nClass name: Foo.;\nnext<|endoftext|>tail",
    "Class name: A\nClass name:  Bar baz:,  \nmore",
    "Class name: <|endoftext|>x",
    "Class name: Foo Bar.\n\t<|endoftext|>",
    "Class name:\n\n",
    "P: Qux.rest,<|endoftext|>",
    "P: two words\nline;",
    "",
]


def _part(raw):
    part = raw.split("Class name:")[-1] if "Class name:" in raw else raw.replace("P:", "")
    return part.split("<|endoftext|>")[0].strip()


def test_completion_first_token(values):
    def expected(raw):
        words = _part(raw).split("\n")[0].strip().rstrip(".:;,").split()
        return words[0] if words else ""

    assert values(lambda x: prompts.completion_token(F.col(x), F.lit("P:")), RAW) == [expected(r) for r in RAW]


def test_completion_line(values):
    def expected(raw):
        cleaned = _part(raw).rstrip(".:;,\n\t").strip()
        return cleaned.split("\n")[0].strip() if "Class name:" in raw else cleaned

    assert values(lambda x: prompts.completion_line(F.col(x), F.lit("P:")), RAW) == [expected(r) for r in RAW]


def test_completion_identifier_and_probe(values):
    inputs = ["Name: Foo bar", "Name: 12 Name: Late", " lead Name:9", "9x", "", "x Name:\n\t_y1-z", "Name:   "]
    assert values(lambda x: prompts.completion_identifier(F.col(x)), inputs) == [
        "Foo", "Name", "lead", "", "", "_y1", "Name",
    ]
    assert values(lambda x: prompts.completion_probe(F.col(x)), inputs) == [
        "Foo", "12", "9", None, None, "_y1-z", "EMPTY",
    ]


def test_prompts_keep_percent_signs(values):
    assert values(lambda x: prompts.render_prompt(F.col(x), "seq2seq"), ["100%s"]) == ["Predict class name:\n100%s\nName:"]
    assert values(lambda x: prompts.render_prompt(F.col(x)), ["a\\$1"]) == ["a\\$1\nClass name:"]
    assert values(lambda x: prompts.training_text(F.col(x), F.lit("T")), ["s"]) == ["s\nClass name: T<|endoftext|>"]
