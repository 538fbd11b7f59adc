"""Registered corpus queries without SQL, and the pipeline, against brute force on whole small tables."""

import zlib
from collections import Counter, defaultdict

import duckdb
import pyarrow.parquet as pq
import pytest
from conftest import DATA
from test_near_copies import brute_first_keys
from test_operators import BLANKS, brute_counts, brute_fingerprint, components, sha

import corpus_pipeline
from namewright.llm import html_text, line_dedup, oracles, quality, queries, token_counts


def read(name):
    return pq.read_table(f"{DATA}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def texts():
    return [(d["doc_id"], d["text"] or "") for d in read("documents")]


def tokenizer(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(public_tokenizers.path(name))
    made.no_truncation()
    made.no_padding()
    return made


def test_each_query_has_sql_or_is_tested_here():
    here = {f"op{n}" for n in (2, 3, 4, 5, 6, 8)}
    elsewhere = {"op11", "op13"}  # test_quality_model.py, test_conversation_repair.py
    with_sql = {name.split("_")[0] for name in oracles.ORACLES}
    assert here | elsewhere | with_sql == {name.split("_")[0] for name in queries.QUERIES} and not here & with_sql


def test_pages(spark):
    got = {r.page_id: r for r in queries.op2_html_extraction(spark, DATA).collect()}
    pages = read("pages")
    assert len(got) == len(pages)
    for page in pages:
        row = got[page["page_id"]]
        assert (row.url, row.text, row.n_chars) == (page["url"], html_text.main_text(page["html"] or ""), len(row.text))


def test_encoding(spark, texts):
    exact = tokenizer("word_bpe_49k.json")
    want = Counter()
    for key, text in texts:
        ids = exact.encode(text, add_special_tokens=False).ids
        want[(key, len(ids), sha(" ".join(map(str, ids))), sha(exact.decode(ids, skip_special_tokens=False)))] += 1
    assert Counter(tuple(r) for r in queries.op3_bpe_encoding(spark, DATA).collect()) == want


def test_conversations(spark):
    control = "</s>[INST] ok [/INST]"
    turns = defaultdict(list, {-1: [(0, "user", control), (1, "assistant", control)]})
    for row in read("conversations"):
        turns[row["conv_id"]].append((row["turn"], row["role"] or "", row["text"] or ""))
    want = Counter()
    for key, rows in turns.items():
        rows.sort()
        loss = "".join(text for _, role, text in rows if role == "assistant")
        want[(key, len(rows), sha("".join(f"{r}\n{t}\n" for _, r, t in rows)), len(loss), sha(loss))] += 1
    got = queries.op4_chat_formatting(spark, DATA).collect()
    assert Counter((r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got) == want
    assert all(r.formatted_chars > r.loss_chars for r in got)


def check_packing(rows, texts, room=1024):
    """Every token of every text stands in one piece, places leave no gaps, and best fit decreasing packs no tighter."""
    exact, pieces, spots = tokenizer("byte_bpe_50k.json"), defaultdict(dict), defaultdict(list)
    for r in rows:
        assert r.piece not in pieces[r.doc_id]
        pieces[r.doc_id][r.piece] = (r.start, r.length, r.ids_crc32)
        spots[r.sequence_id].append((r.offset, r.length))
        assert "ids" not in r or zlib.crc32(r.ids) == r.ids_crc32
    assert set(pieces) == {key for key, _ in texts}
    for key, text in texts:
        ids, at = [*exact.encode(text, add_special_tokens=False).ids, 2], 0
        own = [pieces[key][k] for k in range(len(pieces[key]))]
        for start, length, crc in own:
            assert start == at
            at += length
            assert crc == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[start:at]))
        assert at == len(ids) and len(own) == -(-len(ids) // room)
    for taken in spots.values():
        at = 0
        for offset, length in sorted(taken):
            assert offset == at
            at += length
        assert at <= room
    free = []
    for size in sorted((r.length for r in rows), reverse=True):
        fitting = [i for i, f in enumerate(free) if f >= size]
        if fitting:
            free[min(fitting, key=free.__getitem__)] -= size
        else:
            free.append(room - size)
    assert len(spots) == len(free)


def test_packing(spark, texts):
    check_packing(queries.op5_best_fit_packing(spark, DATA).collect(), texts)


def near_groups(texts):
    """(doc_id, fingerprint, smallest reachable doc_id) of every text."""
    prints = [(key, brute_fingerprint(text)) for key, text in texts]
    group, least = components(sorted({p for _, p in prints}), 2), {}
    for key, p in prints:
        least[group[p]] = min(key, least.get(group[p], key))
    return [(key, f"{p:016x}", least[group[p]]) for key, p in prints]


def test_near_duplicates(spark, texts):
    assert Counter(map(tuple, queries.op6_simhash_dedup(spark, DATA).collect())) == Counter(near_groups(texts))


def test_token_counts(spark, texts):
    from tokenizers import Tokenizer, models, pre_tokenizers

    exact = Tokenizer(models.Unigram(token_counts.vocabulary_pieces(), unk_id=0, byte_fallback=True))
    exact.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    want = Counter((key, len(exact.encode(text, add_special_tokens=False).ids)) for key, text in texts)
    assert Counter(map(tuple, queries.op8_token_counts(spark, DATA).collect())) == want


def test_pipeline_against_brute_force(spark):
    """Verdicts of the quality rules from their SQL; all later stages by loops over what was kept."""
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{DATA}/documents.parquet'")
    judged = con.execute(f"select doc_id, n_words, kept from ({oracles.ORACLES['op1_quality_rules']})").fetchall()
    kept = {key for key, _, keep in judged if keep}
    docs = [d for d in read("documents") if d["doc_id"] in kept]
    assert 0 < len(docs) < len(judged)
    for d in docs:
        n_words, *_, n_repeat = brute_counts(d["text"])
        assert n_words >= 50 and 100 * n_repeat <= 50 * n_words

    sites, first = defaultdict(set), {}
    for d in docs:
        for line in d["text"].split("\n"):
            if bare := line.strip(BLANKS):
                sites[bare].add(d["source"])
                first[bare] = min(d["doc_id"], first.get(bare, d["doc_id"]))
    texts = []
    for d in docs:
        lines = [(line, line.strip(BLANKS)) for line in d["text"].split("\n")]
        stays = [
            line for line, bare in lines
            if not bare or len(sites[bare] - {None}) < line_dedup.MIN_SITES or first[bare] == d["doc_id"]
        ]
        texts.append((d["doc_id"], "\n".join(stays)))
    chosen = set(brute_first_keys(texts))
    packed = corpus_pipeline.run(spark, DATA)
    assert "ids" in packed.columns
    check_packing(packed.collect(), [t for t in texts if t[0] in chosen])


def test_rules_reject_by_each_limit(spark):
    """Every rule of the table can reject a text that the base rules let pass, and none rejects plain prose."""
    import random

    prose = random.Random(3)
    words = [w for w in quality.STOP_WORDS if len(w) > 1] + [f"word{i}" for i in range(300)]
    plain = [" ".join(prose.choice(words) for _ in range(9)) + "." for _ in range(20)]
    bad = {
        "mean_word_chars": [" ".join(prose.choice("abcdefghijk") for _ in range(9)) for _ in range(20)],
        "symbols_per_word": [line.replace("r", "#").replace("o", "$").replace("d", "#") for line in plain],
        "shouts_per_word": [line.replace(" ", "!! ") for line in plain],
        "stop_words_per_word": [" ".join(f"term{prose.randrange(10**6)}" for _ in range(9)) for _ in range(20)],
        "ellipsis_lines_per_line": [line + "..." for line in plain],
        "bullet_lines_per_line": ["- " + line for line in plain],
    }
    rows = [("plain", "\n".join(plain))] + [(name, "\n".join(lines)) for name, lines in bad.items()]
    got = {r.doc_id: r for r in quality.quality_report(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert not any(r.base_failed for name, r in got.items() if name != "mean_word_chars")
    assert {name for name, r in got.items() if not r.kept} == set(bad)
