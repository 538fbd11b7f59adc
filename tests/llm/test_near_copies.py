"""Near copies by five-word shingles against brute force over all pairs."""

import random

import pyarrow.parquet as pq
import pytest
from conftest import DATA

import corpus_pipeline
from namewright.llm import near_copies


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_first_keys(rows):
    """Smallest key of each component of rows whose shingle sets are equal or similar at 0.8."""
    sets, root = {key: shingles(text) for key, text in rows}, {key: key for key, _ in rows}
    for a in sorted(sets):
        for b in [b for b in sets if b < a]:
            both = len(sets[a]) + len(sets[b])
            if sets[a] == sets[b] or 9 * len(sets[a] & sets[b]) >= 4 * both:
                low, high = sorted((root[a], root[b]))
                root = {key: low if r == high else r for key, r in root.items()}
    return sorted(set(root.values()))


@pytest.fixture(scope="module")
def rows():
    """Chains of copies with a few words changed, copies just under the limit, short and empty texts."""
    draw = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    texts = [None, "", " \n", "one", "One ", "two words", "a b c d e", "a b c d e f"]
    for n in (40, 60, 120, 300, 900):
        base = [draw.choice(words) for _ in range(n)]
        for changed in (0.0, 0.005, 0.01, 0.015, 0.02, 0.025, 0.03, 0.06):
            base = [draw.choice(words) if draw.random() < changed else w for w in base]
            texts.append(" ".join(base))
        texts.append("\n".join(w.upper() for w in base))
    draw.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("small_bucket", [32, 1])
def test_near_copies(spark, rows, small_bucket):
    """Also by the way that crowded buckets take; other columns and tied rows stay whole."""
    table = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, n string").repartition(3)
    kept = near_copies.drop_near_copies(table, small_bucket=small_bucket)
    assert kept.columns == table.columns
    want = brute_first_keys(rows)
    assert 10 < len(want) < len(rows) - 10
    assert sorted(r.doc_id for r in kept.collect()) == want
    assert near_copies.drop_near_copies(table.unionAll(table)).count() == len(want)
    assert near_copies.drop_near_copies(table.limit(0)).collect() == []


def test_crowd_of_near_copies_is_one_group(spark):
    """Two hundred copies with two words changed each, beside texts that share half of their words with them."""
    draw = random.Random(5)
    base = [f"w{draw.randrange(500)}" for _ in range(300)]
    rows = []
    for i in range(200):
        copy = list(base)
        for _ in range(2):
            copy[draw.randrange(300)] = f"x{i}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, " ".join(base[:150] + [f"y{i}z{draw.randrange(500)}" for _ in range(150)])) for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in near_copies.drop_near_copies(table, small_bucket=8).collect()}
    assert kept == {0, *range(1000, 1060)}


def template_families(families=300, seed=3):
    """Pairs of texts on one template: similar at 0.8 or more within a family, mostly under it between families."""
    draw = random.Random(seed)
    template = [f"t{i}" for i in range(200)]
    rows = []
    for family in range(families):
        base = list(template)
        for k in range(draw.randrange(1, 9)):
            base[draw.randrange(200)] = f"f{family}x{k}"
        for _ in range(2):
            copy = list(base)
            copy[draw.randrange(200)] = f"c{len(rows)}"
            rows.append((len(rows), " ".join(copy)))
    return rows


@pytest.mark.parametrize("families, small_bucket", [(300, 32), (90, 2)])
def test_families_on_one_template(spark, families, small_bucket):
    """Crowded buckets that hold many components lose no link; several keys tie and repeat."""
    rows = template_families(families)
    table = spark.createDataFrame(rows + rows[:40], "doc_id long, text string").repartition(3)
    kept = sorted(r.doc_id for r in near_copies.drop_near_copies(table, small_bucket=small_bucket).collect())
    want = brute_first_keys(rows)
    assert families / 2 < len(want) < families - 3 and kept == want


def test_crowd_pairs_stay_few(spark):
    """In a crowd on one template most pairs are never made, and none that links is left out."""
    rows = template_families()
    table = spark.createDataFrame(rows, "node long, text string")
    sets = table.select("node", near_copies.shingle_column("text").alias("shingles"))
    mixed = sets.selectExpr("node", "cast(size(shingles) as long) as n", "node as part")
    pairs = {tuple(r) for r in near_copies.crowd_candidates(mixed, sets).collect()}
    whole, links = dict((k, shingles(t)) for k, t in rows), set()
    for a in whole:
        for b in range(a):
            if 9 * len(whole[a] & whole[b]) >= 4 * (len(whole[a]) + len(whole[b])):
                links.add((b, a))
    assert links <= pairs and len(pairs) < len(rows) ** 2 / 10


def test_key_kinds_and_clashing_columns(spark):
    """String and missing keys; columns named like the operator's own; one row of each group stays whole."""
    rows = [("b", "one two three", 1), ("a", "one two three", 2), (None, "one two three", 3), (None, "alone here", 4), (None, None, 5)]
    table = spark.createDataFrame(rows, "id string, body string, node int").selectExpr("*", "1 as h1", "'x' as key", "2 as text", "0 as digest")
    kept = near_copies.drop_near_copies(table, "id", "body")
    assert kept.columns == table.columns
    assert sorted((r.id or "", r.node) for r in kept.collect()) == [("", 4), ("", 5), ("a", 2)]


def test_pipeline_stage_drops_near_copies(spark):
    """A copy with four of 200 words changed is far over two bits of the three-word fingerprint."""
    draw = random.Random(1)
    base = [f"w{draw.randrange(500)}" for _ in range(200)]
    copy = [f"new{i}" if i % 50 == 7 else w for i, w in enumerate(base)]
    rows = [(10**6, " ".join(base)), (10**6 + 1, " ".join(copy))]
    rows += [(d["doc_id"], d["text"]) for d in pq.read_table(f"{DATA}/documents.parquet").to_pylist()]
    stage = dict(corpus_pipeline.STAGES)["near_copies"]
    kept = stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    want = brute_first_keys(rows)
    assert 10**6 in want and 10**6 + 1 not in want
    assert sorted(r.doc_id for r in kept) == want


def test_pipeline_stage_links_by_simhash(spark, monkeypatch):
    """Near copies whose fingerprints are near are found without any MinHash band; others that are near by chance are not dropped."""
    draw = random.Random(5)
    words = [f"w{i}" for i in range(500)]
    texts = []
    for _ in range(6):
        base = [draw.choice(words) for _ in range(1500)]
        texts += [" ".join(base), " ".join([*base, "end"]), " ".join(["start", *base])]
    prints = [near_copies.set_fingerprint(near_copies.shingle_set(text.encode())) for text in texts]
    assert all(bin((prints[i] ^ prints[i + k]) % (1 << 64)).count("1") <= 2 for i in range(0, 18, 3) for k in (1, 2))
    monkeypatch.setattr(near_copies, "candidates", lambda met, *_: spark.createDataFrame([], "a long, b long"))
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    stage = dict(corpus_pipeline.STAGES)["near_copies"]
    assert sorted(r.doc_id for r in stage(spark, table, DATA).collect()) == list(range(0, 18, 3)) == brute_first_keys(list(enumerate(texts)))
