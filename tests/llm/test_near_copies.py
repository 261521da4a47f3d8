import random
from collections import Counter

import pytest
from helpers import documents, empty, needs_tables, odd, plain_components

from starloom.llm import near_copies
from starloom.llm.components import components
from starloom.llm.near_copies import near_copy_components, one_of_each_group


def _run(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_copy_components(df).collect()}


@needs_tables
def test_against_all_pairs_on_documents(spark):
    docs = documents(spark)
    assert _run(docs) == plain_components([(r["doc_id"], r["text"]) for r in docs.collect()])


def _families(seed, families=6, copies=30):
    """Groups of edited copies around the threshold, and short texts made mostly of shared passages."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    rows = []
    passages = [[word() for _ in range(rng.choice([15, 25]))] for _ in range(3)]
    for _ in range(families):
        base = [word() for _ in range(rng.choice([12, 40, 120]))]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(4)):
                text[rng.randrange(len(text))] = word()
            rows.append(text)
    for _ in range(60):
        rows.append(rng.choice(passages) + [word() for _ in range(rng.randrange(10))])
    rows += [[word() for _ in range(30)] for _ in range(40)] + rows[:10]
    rng.shuffle(rows)
    return [(i, " ".join(t)) for i, t in enumerate(rows)]


@pytest.mark.parametrize(("frequent", "combined", "crowded"), [(16, 24, 64), (3, 24, 4), (1, 0, 10)])
def test_against_all_pairs_with_every_kind_of_key(spark, monkeypatch, frequent, combined, crowded):
    """Rare single tokens, combinations of frequent ones, frequent ones by themselves; pairs by key and by block."""
    monkeypatch.setattr(near_copies, "FREQUENT", frequent)
    monkeypatch.setattr(near_copies, "MOST_COMBINED", combined)
    monkeypatch.setattr(near_copies, "CROWDED", crowded)
    monkeypatch.setattr(near_copies, "BLOCK_CLASSES", 7)
    rows = _families(frequent)
    assert _run(spark.createDataFrame(rows, "doc_id long, text string")) == plain_components(rows)


def test_links_through_a_row_without_an_id(spark):
    """A links to B and B to C; whether B has an id or not, all three are one component."""
    base = [f"w{k}" for k in range(100)]
    a, b, c = base, base[:-9] + [f"x{k}" for k in range(9)], base[9:-9] + [f"x{k}" for k in range(9)] + [f"y{k}" for k in range(1)]
    sets = {k: {tuple(t[i:i + 5]) for i in range(len(t) - 4)} for k, t in (("a", a), ("b", b), ("c", c))}
    near = lambda x, y: 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y])
    assert near("a", "b") and near("b", "c") and not near("a", "c")
    for of_b in (2, None):
        rows = [(1, " ".join(a)), (of_b, " ".join(b)), (of_b, " ".join(b)), (3, " ".join(c)), (None, "all by itself without an id"), (None, None)]
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        got = Counter((r["doc_id"], r["component_id"]) for r in near_copy_components(frame).collect())
        assert got == Counter({(1, 1): 1, (of_b, 1): 2, (3, 1): 1}) + Counter([(None, None)] * 2)
        left = Counter((r["doc_id"], r["text"]) for r in one_of_each_group(frame).collect())
        assert left == Counter([rows[0], rows[4], rows[5]])


def test_one_stays_of_a_group_without_ids(spark):
    text = [" ".join(f"w{k}" for k in range(n)) for n in (60, 61, 62)]
    rows = [(None, text[0], "a"), (None, text[0], "b"), (None, text[1], "a"), (None, text[2], "c"), (None, "  ", "x"), (None, "  ", "x")]
    left = one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string, h string")).collect()
    assert len(left) == 3 and sum(r["text"] in text for r in left) == 1 and left[0].asDict().keys() == {"doc_id", "text", "h"}


def test_odd_rows(spark):
    got = near_copy_components(odd(spark)).collect()
    assert len(got) == 11
    by_id = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}
    assert by_id[1] == (2, 1) and by_id[2] == (2, 1)
    assert by_id[3] == (0, 3) and by_id[4] == (0, 4) and by_id[5] == (0, 5)
    assert by_id[6] == (1, 6) and by_id[7] == (1, 6)
    assert by_id[None] == (3, None)
    assert near_copy_components(empty(spark)).count() == 0


def test_one_of_each_group_stays(spark):
    kept = one_of_each_group(odd(spark))
    assert kept.columns == odd(spark).columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [
        (False, i) for i in (1, 3, 4, 5, 6, 8, 9)] + [(True, 0)]
    assert one_of_each_group(empty(spark)).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (200, None)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


@needs_tables
def test_query_matches_its_oracle(spark):
    import duckdb
    from helpers import SF

    from starloom.llm.queries import QUERIES, QUERY_ORACLES

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    got = QUERIES["op10_ngram_jaccard"](spark, SF)
    want = con.execute(QUERY_ORACLES["op10_ngram_jaccard"]).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
