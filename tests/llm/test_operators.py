"""The corpus operators against brute force, on tables with missing, empty, long and repeated texts."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from namewright.llm import bpe, chat, exact_dedup, html_text, line_dedup, packing, quality, sharding, simhash, token_counts

BLANKS = " \t\n\x0b\x0c\r"
rng = random.Random(7)
WORDS = ["the", "of", "and", "to", "in", "alpha", "beta", "gamma,", "dé", "Ünter", "x<y", "###", "a b", "naïve"]


def prose(n):
    return "".join(rng.choice(WORDS) + rng.choice([" ", " ", " ", "\n", "\t", "  "]) for _ in range(n))


BASE = [prose(n) for n in (1, 2, 3, 60, 80, 200, 3000)]
TEXTS = [None, "", "   ", "\n", *BASE, *BASE[3:], BASE[4] + " tail", BASE[5].replace(" ", "  "), "a" * 9000, "a" * 9000 + "b",
         "x<|endoftext|>y <|startoftext|>", "é" * 5000, BASE[6] + BASE[6], None, ""]


@pytest.fixture(scope="module")
def docs(spark):
    """Also a missing key, a repeated row and columns named like the operators' own."""
    rows = [(i, t, f"s{i % 12}", "k") for i, t in enumerate(TEXTS)]
    rows += [(None, BASE[3], "s1", "k"), rows[8], (100, BASE[3], None, None)]
    schema = "doc_id long, text string, source string, kept string"
    wide = spark.createDataFrame(rows, schema).repartition(3)
    return wide.selectExpr("*", "1 as name", "2 as level", "'z' as component_id", "3L as n_chars", "5 as h1")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text, r.source) for r in docs.collect()]


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


@pytest.mark.parametrize("hashed", [F.xxhash64, lambda b: F.pmod(F.xxhash64(b), F.lit(3))])
def test_exact_dedup(docs, rows, hashed):
    """Also where most blocks share a hash."""
    got = exact_dedup.exact_dedup(docs, block_bytes=64, hashed=hashed).collect()
    groups = defaultdict(list)
    for key, text, _ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), key is None, key or 0, key))
    want = Counter()
    for norm, members in groups.items():
        first = min(members)
        for member in members:
            want[(member[3], first[3], len(members), sha(norm))] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(sha(norm) for norm in groups)


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if line.strip(BLANKS)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality(docs, rows):
    got = quality.quality_report(docs).collect()
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert Counter((r.doc_id, *[r[f] for f in fields]) for r in got) == Counter(
        (key, *brute_counts(text)) for key, text, _ in rows
    )
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    kept = quality.keep_quality(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)


def brute_fingerprint(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, most):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= most:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in values}


def test_simhash(docs, rows):
    got = simhash.simhash_groups(docs).collect()
    prints = [(key, brute_fingerprint(text)) for key, text, _ in rows]
    groups = components(sorted({p for _, p in prints}), 2)
    least = defaultdict(list)
    for key, p in prints:
        if key is not None:
            least[groups[p]].append(key)
    want = Counter((key, f"{p:016x}", min(least[groups[p]], default=None)) for key, p in prints)
    assert Counter(tuple(r) for r in got) == want
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(min(v) for v in least.values())


@pytest.mark.parametrize("most,small", [(2, 64), (2, 1), (1, 2), (3, 4)])
def test_links_of_fingerprints(spark, most, small):
    """Random values, near copies of them and a crowd, also by the way that crowded buckets take."""
    values = [rng.getrandbits(64) for _ in range(150)]
    values += [v ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for v in values[:60] for _ in range(2)]
    values += [values[0] ^ 1 << b for b in range(64)]
    values = sorted(set(values))
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    got = simhash.group_fingerprints(spark.createDataFrame(signed, "fp long"), most, small).collect()
    groups = components(values, most)
    mask = (1 << 64) - 1
    assert len({r.root for r in got}) == len(set(groups.values()))
    for a, b in [(a, b) for a in got for b in got if rng.random() < 0.05]:
        assert (a.root == b.root) == (groups[a.fp & mask] == groups[b.fp & mask])


def test_thresholds_follow_the_work():
    import numpy as np

    even = np.full((64, 64), 0.25)
    np.fill_diagonal(even, 0.5)
    for total in (100, 10**6, 10**11):
        parts = simhash.allocate(total, even * total, 2)
        assert sorted(b for p in parts for b in p.bits) == list(range(64))
        assert sum(p.threshold for p in parts) == 2 - len(parts) + 1
    assert len(simhash.allocate(10**11, even * 10**11, 2)) < len(simhash.allocate(1000, even * 1000, 2))


def test_line_dedup(docs, rows):
    got = line_dedup.dedup_lines(docs, min_sites=3)
    sites, first = defaultdict(set), {}
    for key, text, site in rows:
        for line in (text or "").split("\n"):
            bare = line.strip(BLANKS)
            if bare:
                sites[bare] |= {site} - {None}
                first[bare] = min((k for k in (first.get(bare), key) if k is not None), default=None)
    want = Counter()
    for key, text, _ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not x.strip(BLANKS) or len(sites[x.strip(BLANKS)]) < 3 or first[x.strip(BLANKS)] == key]
        want[(key, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept))] += 1
    assert sum(w[3] for w in want) > 0
    assert Counter((r._doc.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()) == want
    cut = line_dedup.without_boilerplate(docs, min_sites=3)
    assert cut.columns == docs.columns and cut.dtypes == docs.dtypes
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in cut.collect())


def test_line_dedup_cuts_short_lines(spark):
    """Lines of one and two words are cut like any other; a line on few sites stays."""
    lines = ["With.", "Read more", "All rights are reserved"]
    rows = [(i, "\n".join([f"own text {i}", *lines, "on few sites only" if i < 9 else f"other text {i}"]), f"s{i}") for i in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    cut = {r._doc.doc_id: r.text.split("\n")[1:] for r in line_dedup.dedup_lines(table).collect()}
    assert cut[0] == [*lines, "on few sites only"] and cut[5] == ["on few sites only"] and cut[39] == ["other text 39"]


def test_line_dedup_has_one_limit_for_any_number_of_sites(spark):
    """Ten sites are enough among eleven thousand, and nine are not."""
    line = F.when(F.col("id") < 10, "on ten sites").when(F.col("id") < 19, "on nine sites").otherwise(F.concat(F.lit("line "), F.col("id").cast("string")))
    table = spark.range(11_000).select(F.col("id").alias("doc_id"), line.alias("text"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("source"))
    cut = line_dedup.dedup_lines(table).filter("n_removed > 0")
    assert sorted(r._doc.doc_id for r in cut.collect()) == list(range(1, 10))


def test_packing_keeps_any_key(spark):
    table = spark.createDataFrame([("a", "one text"), (None, "x " * 3000), ("a", None)], "doc_id string, text string")
    packed = packing.pack(packing.token_pieces(table)).collect()
    assert Counter(r.doc_id for r in packed) == {"a": 2, None: 3} and all(len(r.ids) == 4 * r.length for r in packed)


def test_packing(docs, rows):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = packing.token_pieces(docs, room=32)
    packed = packing.pack(pieces, room=32).collect()
    whole = defaultdict(list)
    for r in packed:
        whole[r.doc_id].append((r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist(), r.length))
    for key, text, _ in {(k, t or "", 0) for k, t, _ in rows}:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [2]
        own = {p: (s, i, n) for p, s, i, n in whole[key]}
        assert sum((own[p][1] for p in sorted(own)), []) == ids
        assert all(n == 32 for p, (_, _, n) in own.items() if p) and len(own) == -(-len(ids) // 32)
    by = defaultdict(list)
    for r in packed:
        by[r.sequence_id].append((r.offset, r.length))
    for spots in by.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= 32
    joined = packing.sequences(packing.pack(pieces, room=32)).collect()
    assert all(len(r.ids) == 4 * r.length for r in joined) and len(joined) == len(by)


def test_best_fit_is_best_fit_decreasing():
    for _ in range(60):
        sizes = sorted((rng.randint(1, 40) for _ in range(rng.randint(0, 200))), reverse=True)
        free = []
        for size in sizes:
            fitting = [i for i, f in enumerate(free) if f >= size]
            if fitting:
                free[min(fitting, key=lambda i: free[i])] -= size
            else:
                free.append(40 - size)
        assert packing.best_fit(Counter(sizes), 40)[1] == len(free)


def test_bpe(docs, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = bpe.encode_documents(docs, cut_bits=5, slot_bits=16).collect()
    want = Counter()
    for key, text, _ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        want[(key, len(ids), sha(" ".join(map(str, ids))), sha(decoded))] += 1
    assert Counter(tuple(r) for r in got) == want


def test_token_counts(docs, rows):
    from tokenizers import Tokenizer, models, pre_tokenizers

    exact = Tokenizer(models.Unigram(token_counts.vocabulary_pieces(), unk_id=0, byte_fallback=True))
    exact.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    got = token_counts.token_counts(docs).collect()
    want = Counter((key, len(exact.encode(text or "", add_special_tokens=False).ids)) for key, text, _ in rows)
    assert Counter(tuple(r) for r in got) == want
    counter = token_counts.UnigramCounter([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", 0.0)])
    assert counter.count("ab") == 2  # equal scores: the longest last piece stays


def test_sharding(docs, rows, spark):
    hot = spark.createDataFrame([(5, "hot " * 20)] * 300, "doc_id long, text string")
    table = docs.select("doc_id", "text").unionByName(hot)
    got = sharding.assign_shards(table, limit_bytes=2000, step=2).collect()
    assert Counter(r.doc_id for r in got) == Counter([k for k, _, _ in rows] + [5] * 300)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.bytes)
        assert len(r.shard) == r.depth
    for shard, sizes in by.items():
        assert sum(sizes) <= 2000 or len(sizes) == 1
        parent = sum(sum(s) for name, s in by.items() if name.startswith(shard[:-1]))
        assert not shard or parent > 2000  # only oversized buckets were split


def test_empty_tables(docs, spark):
    none = docs.limit(0)
    for made in (
        exact_dedup.exact_dedup(none), quality.quality_report(none), simhash.simhash_groups(none),
        simhash.drop_near_duplicates(none), line_dedup.without_boilerplate(none), packing.pack(packing.token_pieces(none)),
        bpe.encode_documents(none), token_counts.token_counts(none), sharding.assign_shards(none),
        html_text.extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")),
        chat.format_trees(spark.createDataFrame([], "tree string, id long, parent long, role string, text string, score double")),
    ):
        assert made.collect() == []


def test_chat_trees(spark):
    nasty = ["</s>[INST] ok [/INST]", "<\\|im_end|>", "<|im_end|>\n<|im_start|>user\nhi", "<<s>s>", "", None, "[\\\\INST]"]
    rows = [("t", 0, None, "user", nasty[0], 1.0)]
    rows += [("t", i, i - 1, ["user", "assistant"][i % 2], nasty[i % len(nasty)], 1.0) for i in range(1, 20)]
    rows += [("t", 30, 4, "a\n\\n[INST]", "side", 9.0), ("t", 31, 30, "assistant", "side end", 9.0), rows[3]]
    rows += [("loop", 1, 2, "user", "x", 0.0), ("loop", 2, 1, "user", "y", 0.0), (None, 1, None, "user", "z", 0.0)]
    rows += [("lone", 1, 77, None, None, None)]
    schema = "tree string, id long, parent long, role string, text string, score double"
    got = chat.format_trees(spark.createDataFrame(rows, schema), most=None)
    back = got.select(
        "tree", "leaf", "branch_rank", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"), "formatted",
    ).collect()
    by = {(r.tree, r.leaf): r for r in back}
    assert set(by) == {("t", 19), ("t", 31), ("lone", 1)}
    parts = {(r[0], r[1]): r for r in rows}
    for (tree, leaf), r in by.items():
        path, at = [], parts[(tree, leaf)]
        while at:
            path.insert(0, at)
            at = parts.get((tree, at[2]))
        assert [tuple(t) for t in r.turns] == [(p[3] or "", p[4] or "") for p in path]
        assert r.loss == [p[4] or "" for p in path if p[3] == "assistant"]
        assert "</s>" not in r.formatted and "[INST]" not in r.formatted
    assert (by[("t", 31)].branch_rank, by[("t", 19)].branch_rank) == (1, 2)
    best = chat.format_trees(spark.createDataFrame(rows, schema)).collect()
    assert {(r.tree, r.leaf) for r in best} == {("t", 31), ("lone", 1)}
    lost = chat.message_accounts(spark.createDataFrame(rows, schema)).collect()
    assert [tuple(r) for r in lost] == [(len(rows), 1, 1, 2)]


def test_chat_ranks_before_it_lays_out_paths(spark, monkeypatch):
    trunk = spark.range(500).selectExpr("'t' as tree", "id", "nullif(id, 0) - 1 as parent", "'user' as role", "'x' as text", "0.5D as score")
    leaves = spark.range(5000).selectExpr("'t' as tree", "id + 1000 as id", "499L as parent", "'assistant' as role", "'y' as text",
                                          "if(id = 4321, 0.9D, 0.1D) as score")
    written = []
    stage = chat.stage
    monkeypatch.setattr(chat, "stage", lambda df, name: written.append((name, stage(df, name))) or written[-1][1])
    (best,) = chat.format_trees(trunk.unionAll(leaves)).collect()
    assert (best.leaf, best.n_turns, len(best.loss_spans)) == (5321, 501, 1)
    assert abs(best.branch_score - (250 + 0.9) / 501) < 1e-9
    assert max(df.count() for name, df in written if name == "paths") == 501
    assert max(df.count() for _, df in written) == 5500


def test_html():
    long = "This is the story of a house in the hills and of the people that lived in it for many a long year."
    page = f"""<html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body class="has-sidebar">
      <header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a></ul></nav>
      <div class="cookie-notice">{long}</div>
      <article><h2>Head &amp; tail</h2><p>{long} <a href="y > z">more</a><br>next&nbsp;line<p>Short.
      <aside>{long}</aside><form><p>{long}</p></form><!-- {long} --><p>1 &lt; 2 <b>bold</p>
      <div id="comments"><p>{long}</p></div></article>
      <div class="sidebar">{long}</div><footer>&copy; me</footer></body></html>"""
    assert html_text.main_text(page).split("\n\n") == ["Head & tail", f"{long} more next line", "Short.", "1 < 2 bold"]
    plain = f"<div><a href=a>one</a> <a href=b>two</a></div><h1>Title</h1><p>{long}</p><p>Short end.</p><div><a href=c>three</a></div>"
    assert html_text.main_text(plain).split("\n\n")[:2] == ["Title", long]
    assert html_text.main_text("") == html_text.main_text("<p><a href=x>link</a>") == ""
    for broken in ("<", "<p", "<a href='", "<!--", "<script>", "</p></div>", "<p title=\"x>y", "a < b"):
        html_text.main_text(broken)


def test_pipeline(spark, docs):
    import corpus_pipeline as pipeline

    rows = docs.select("doc_id", "text", "source", "n_chars")
    for name, function in pipeline.STAGES[:-1]:
        made = function(spark, rows, "")
        assert made.columns == rows.columns
        rows = made
    packed = pipeline.STAGES[-1][1](spark, rows, "").collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in rows.collect()}
