"""Whitening, hard negatives and chat formatting on small tables: nulls, ties, repeats, long rows, clashing names."""

import hashlib
import json
import random

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lendreach.checks.verify import compare
from lendreach.llm import chat, negatives, queries, whitening

SF = "/root/testdata/sf0.001"
VEC = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows):
    return spark.createDataFrame(rows, VEC)


def random_rows(seed, n, dim, labels=4):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)).round(2)
    return [(i, [float(v) for v in x[i]], int(rng.integers(labels))) for i in range(n)]


ODD = [(9001, None, 1), (9002, [], 1), (9003, [1.0, None, 0.0, 2.0], 1), (9004, [1.0, float("nan"), 0.0, 2.0], 1),
       (9005, [1.0, float("inf"), 0.0, 2.0], 1)]


# ---- 11: whitening ---------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(6))
def test_counts_are_those_of_the_eigenvalues(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 24))
    q = np.linalg.qr(rng.standard_normal((n, n)))[0]
    e = rng.integers(-3, 4, n).astype(float)            # many equal ones, both signs
    a = (q * e) @ q.T
    for s in (-3.5, -2.5, -0.5, 0.5, 1.5, 3.5):
        assert whitening.below((a + a.T) / 2, s) == (e < s).sum()
    swapped = np.array([[0.0, 1.0], [1.0, 0.0]])        # no pivot of size one
    assert [whitening.below(swapped, s) for s in (-2, 0, 2)] == [0, 1, 2]


@pytest.mark.parametrize("kind", ["plain", "rank", "equal", "close", "zero", "one"])
def test_leading_vectors(kind):
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.standard_normal((20, 20)))[0]
    e = {"plain": np.arange(20, 0, -1.0), "rank": np.r_[[5.0, 4, 3], np.zeros(17)], "equal": np.full(20, 2.0),
         "close": np.r_[[5, 5 + 1e-13, 5 + 1e-9, 5], np.ones(16)], "zero": np.zeros(20), "one": np.array([3.0])}[kind]
    a = np.array([[3.0]]) if kind == "one" else (q * e) @ q.T
    values, u = whitening.leading((a + a.T) / 2, 8)
    k = min(8, len(e))
    assert np.allclose(values, np.sort(e)[::-1][:k], rtol=1e-13, atol=1e-13) and np.allclose(u @ u.T, np.eye(k), atol=1e-12)
    assert np.allclose(a @ u.T, u.T * values, atol=1e-12)


def test_whitening_follows_the_plain_formula(spark):
    rows = random_rows(1, 300, 6)
    rows += [(300, rows[0][1], 0), (0, rows[0][1], 0), (None, rows[5][1], None)]        # copies, a null id
    df = vectors(spark, rows + [(i, v and [*v, 0.0, 0.0][:6], y) for i, v, y in ODD]).withColumn("dim", F.lit("x")).withColumn("n", F.lit(1))
    got = whitening.whiten(df, 4).collect()
    x = np.floor(1024 * np.array([r[1] for r in rows], np.float32).astype(float)).astype(int) + 100_000
    n, s = len(x), x.sum(axis=0)
    v = np.cov((x - s / n).T, bias=True)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:4], u[:, ::-1][:, :4]
    want = (x - s / n) @ u / np.sqrt(e)
    assert len(got) == n and {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-9 and np.allclose(got[0].explained, e / np.trace(v), rtol=1e-12)
    by = {(-1 if r.vec_id is None else r.vec_id): r for r in got}
    w = np.array([by[-1 if r[0] is None else r[0]].whitened for r in rows])
    assert np.allclose(w * np.sign((w * want).sum(axis=0)), want, atol=1e-9)
    dev = ((n * x - s) ** 2).sum(axis=1)
    assert all(by[-1 if r[0] is None else r[0]].deviation == d for r, d in zip(rows, dev, strict=True))
    assert np.allclose(np.cov(w.T, bias=True), np.eye(4), atol=1e-9)


def test_whitening_does_not_depend_on_the_partitions(spark):
    df = vectors(spark, random_rows(2, 200, 5))
    a, b = (sorted(map(tuple, whitening.whiten(df.repartition(p), 3).select(
        "vec_id", "whitened", "explained", "deviation").collect())) for p in (1, 7))
    assert a == b


def test_whitening_of_odd_tables(spark):
    assert whitening.whiten(vectors(spark, []), 8).count() == 0 == whitening.whiten(vectors(spark, ODD[:2]), 8).count()
    same = whitening.whiten(vectors(spark, [(i, [1.0, 2.0, 3.0], 0) for i in range(5)]), 8).collect()
    assert all(r.whitened == [None] * 3 and r.deviation == 0 and r.identity_error is None for r in same) and len(same) == 5
    # two lengths are fitted apart; one direction carries all variance of the shorter
    mixed = vectors(spark, [(i, [float(i), 1.0], 0) for i in range(4)] + [(10 + i, v, 0) for i, v, _ in random_rows(4, 30, 3)])
    got = {r.vec_id: r for r in whitening.whiten(mixed, 8).collect()}
    assert len(got) == 34 and got[0].n == 4 and got[10].n == 30 and [len(got[i].whitened) for i in (0, 10)] == [2, 3]
    assert got[0].whitened[1] is None and abs(abs(got[0].whitened[0]) - 1.5 / np.sqrt(1.25)) < 1e-12
    big = whitening.whiten(vectors(spark, [(0, [3e38, 0.0], 0), (1, [-3e38, 1.0], 0), (2, [1.0, 5.0], 0)]), 2).collect()
    assert len(big) == 3 and big[0].identity_error < 1e-3 and any(r.deviation is None for r in big)
    rows = whitening.per_component(whitening.whiten(vectors(spark, random_rows(5, 20, 3)), 2))
    assert rows.count() == 40 and sorted({r.component for r in rows.collect()}) == [1, 2]


def test_sums_keep_every_bit():
    rng = np.random.default_rng(5)
    big = np.array([2**90 + 3, -(2**100) - 7, 0, -1, 2**39], object)
    assert whitening.whole(whitening.limbs(big)) == big.tolist()
    small = rng.integers(-2**61, 2**61, 50)
    assert whitening.whole(whitening.limbs(small)) == small.tolist()
    for peak in (100, 2**27, 2**40):
        z = rng.integers(-peak, peak, (40, 3))
        assert (whitening.gram(z).astype(object) == z.astype(object).T @ z.astype(object)).all()


# ---- 12: hard negatives ----------------------------------------------------------------------------

@pytest.mark.parametrize("span", [3, 200, 10_000, 2**20, 2**31 - 1])
def test_packed_products_are_exact(span):
    rng = np.random.default_rng(span)
    for n, d in ((1, 1), (7, 3), (1030, 5)):
        c, a = rng.integers(-span, span + 1, (n, d)), rng.integers(-span, span + 1, (4, d))
        got = negatives.Packed(c).scores(a)
        assert (got.astype(object) == a.astype(object) @ c.astype(object).T).all()
    flat = negatives.Packed(np.zeros((3, 2), np.int64))
    assert (flat.scores(np.zeros((2, 2), np.int64)) == 0).all()


def plain_mine(rows, every, positives=5, most=10):
    rows = [(i, tuple(np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)), y) for i, v, y in rows]
    out = []
    for a in rows:
        if a[0] % every:
            continue
        score = {r[0]: int(np.dot(a[1], r[1])) for r in rows if r[0] != a[0] and len(r[1]) == len(a[1])}
        label = {r[0]: r[2] for r in rows}
        best = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in best if label[i] == a[2]][:positives]:
            fit = [i for i in best if label[i] != a[2] and 30 * score[p] <= 100 * score[i] <= 90 * score[p]][:most]
            out += [(a[0], p, k, i, score[p], score[i]) for k, i in enumerate(fit, 1)]
    return sorted(out)


def test_negatives_against_all_pairs(spark, monkeypatch):
    rows = random_rows(7, 260, 6) + [(1000 + i, [0.5, 0.5, 0.0, 0.0, 0.0, 0.1], i % 3) for i in range(60)]   # ties
    rows += [(2000 + i, [1.0, 2.0], i % 2) for i in range(30)]      # another length
    odd = [(i, v, y) for i, v, y in ODD] + [(8000, [1.0] * 6, None), (None, [1.0] * 6, 1)]
    df = vectors(spark, rows + odd + rows[:40]).withColumn("block", F.lit(1)).withColumn("pairs", F.lit("x"))
    want = plain_mine(rows, 4)
    assert len(want) > 500 and sorted(map(tuple, negatives.mine(df, F.col("id") % 4 == 0).collect())) == want
    monkeypatch.setattr(negatives, "ROWS", 50)          # many blocks and pieces
    assert sorted(map(tuple, negatives.mine(df, F.col("id") % 4 == 0).collect())) == want


def test_negatives_of_odd_tables(spark):
    def mine(rows):
        return sorted(map(tuple, negatives.mine(vectors(spark, rows), F.col("id") % 100 == 0).collect()))
    assert mine([]) == mine(ODD) == mine([(0, [1.0], 1)]) == mine([(0, [1.0], 1), (1, [1.0], 2)]) == []
    assert mine([(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2), (3, [0.95], 2)]) == [(0, 1, 1, 2, 65536, 32768)]
    assert mine([(0, [1.0], 1), (1, [-1.0], 1), (2, [-0.5], 2)]) == []      # the positive scores below 0
    # a repeated id counts once, with its least (label, vector)
    assert mine([(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 3), (2, [0.25], 3), (2, [0.5], 1)]) == []
    assert mine([(0, [3e38], 1), (1, [3e38], 1), (2, [1e38], 2)]) == []     # held: all three score alike


# ---- 13: chats -------------------------------------------------------------------------------------

@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "a>b\\<", "", "</turn>\n"]),
                          st.text(alphabet="<\\/turn> \né𝄞#", max_size=30)), max_size=6))
def test_templates_read_back(turns):
    text = "".join(chat.formatted(r, t)[0] for r, t in turns)
    assert chat.read_back(text) == turns
    for r, t in turns:
        whole, a, z = chat.formatted(r, t)
        assert chat.unescape(whole[a:z]) == t and (not t or "</turn" not in whole[a:z].replace("\\</turn", ""))


def test_layouts_are_chosen_by_their_paths(spark):
    records = [
        {"prompt": "p", "completion": "c"}, {"system": "s", "prompt": "p", "completion": "c"},
        {"instruction": "i", "input": "", "output": "o"}, {"instruction": "i", "input": "x", "output": "o"},
        {"messages": [{"role": "human", "content": "h"}, {"role": "gpt", "content": None}]},
        {"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": 7}], "id": "more fields"},
        {"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]},
        {"prompt": "p", "response": "r", "score": {"a": 1}}, {"turn": 3, "prompt": "p"},
        {"nothing": 1}, [], 5, {"messages": []}]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)] + [(50, None), (51, "{broken")],
                               "conv_id long, record string")
    got = {}
    for r in chat.canonical_turns(df).orderBy("conv_id", "place").collect():
        got.setdefault(r.conv_id, (r.layout, []))[1].append((r.role, r.text))
    assert {k: v[0] for k, v in got.items()} == dict(enumerate(
        ["prompt", "prompt", "instruction", "instruction", "messages", "speakers", "parts", "response", "prompt-row",
         None, None, None, None])) | {50: None, 51: None}
    assert got[1][1] == [("system", "s"), ("user", "p"), ("assistant", "c")]
    assert got[2][1] == [("user", "i"), ("assistant", "o")] and got[3][1][1] == ("user", "x")
    assert got[4][1] == [("user", "h"), ("assistant", "")] and got[5][1][1] == ("assistant", "7") and got[6][1] == [("user", "ab")]
    assert {r.conv_id for r in chat.unmapped(chat.canonical_turns(df)).collect()} == {9, 10, 11, 12, 50, 51}
    prints = [chat.fingerprint(chat.field_paths(r)) for r in records]
    assert prints[2] == prints[3] != prints[1] and chat.fingerprint(chat.field_paths({"b": 1, "a": [{"c": 2}]})) == \
        chat.fingerprint(chat.field_paths({"a": [{"c": 0}, {"c": None}], "b": "x"}))


def digest(rows):
    """conv_id -> what the contract asks for, straight from the rows."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))]
        loss = "".join(t for r, t in mine if r == "assistant")
        out[conv] = (len(mine), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in mine).encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest(), sum(len(chat.formatted(r, t)[0]) for r, t in mine))
    return out


def test_chats_of_any_length(spark, monkeypatch):
    rnd = random.Random(3)
    text = lambda: rnd.choice([None, "", "<turn user>", "a\\</turn>\n b", "é" * 900, "x\ud7ff\n\n"])
    rows = [(c, t, rnd.choice(["user", "assistant", "system", "tool", None]), text()) for c in range(40) for t in range(rnd.randint(1, 6))]
    rows += [(500, t, "assistant" if t % 2 else "user", f"turn {t} " * 40) for t in range(900)]     # a third of all rows
    rows += [(None, 0, "user", "no name"), (None, None, "assistant", "first"), (7000, 0, "user", "z" * 200_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("seq", F.lit(0)).withColumn("tie", F.lit("x"))
    for segment in (1 << 20, 3000):
        monkeypatch.setattr(chat, "SEGMENT", segment)
        chats = chat.format_chats(chat.canonical_turns(queries.as_records(df)))
        got = {r[0]: tuple(r)[1:] for r in chat.digests(chats.repartitionByRange(5, *chat.ORDER).sortWithinPartitions(*chat.ORDER)).collect()}
        assert got == digest(rows)
        one = [r for r in chats.filter("conv_id = 500").orderBy(*chat.ORDER).collect()]
        assert sum(r.n_turns for r in one) == 900 and (len(one) > 100) == (segment == 3000)
    learned = "".join(chat.unescape(r.formatted[s.start:s.end]) for r in one for s in r.loss)
    assert learned == "".join(r[3] for r in rows if r[0] == 500 and r[2] == "assistant")
    none = df.limit(0)
    assert chat.digests(chat.format_chats(chat.canonical_turns(queries.as_records(none)))).count() == 0


def test_repeated_turns_count_each(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "assistant", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    (got,) = chat.digests(chat.format_chats(chat.canonical_turns(queries.as_records(df)))).collect()
    assert tuple(got)[1:] == digest(rows)[1]
    ties = [(1, 0, "user", x) for x in ("a", "b", "c")]
    df = spark.createDataFrame(ties, "conv_id long, turn long, role string, text string")
    seen = {chat.digests(chat.format_chats(chat.canonical_turns(queries.as_records(df.repartition(p))))).first().turns_sha256 for p in (1, 3)}
    assert len(seen) == 1


@pytest.mark.parametrize("name", ["op12_negatives", "op13_chat"])
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    ok, n, why = compare(spark, con, queries.QUERIES[name], queries.ORACLES[name], SF)
    assert ok and n > 15, why


def test_whitening_query_has_every_row(spark):
    out = queries.op11_whitening(spark, SF)
    assert out.count() == 8 * spark.read.parquet(f"{SF}/embeddings.parquet").count()
    assert out.agg(F.max("identity_error")).first()[0] < 1e-9
