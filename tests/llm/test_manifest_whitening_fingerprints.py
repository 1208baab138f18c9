"""Merkle manifest, embedding whitening and document fingerprints against brute force, and on awkward rows."""

import collections
import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from stationlab.llm import fingerprints, merkle, whitening
from stationlab.llm.oracle import SQL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, pos string, run int, __a int"


def documents():
    """Awkward documents: nulls in every column, ties, repeated rows, a hot source, a long text; helper names as columns."""
    out = []
    for i in range(300):
        source = None if i % 13 == 0 else "hot" if i % 3 else f"s{i % 7}é"
        text = None if i % 29 == 0 else "" if i % 31 == 0 else "\n".join(f"Line {j * i} of text {i}. It ends! Ü{i * j}" for j in range(i % 11))
        out.append((i, text, None if i % 5 == 0 else "en", source, None if i % 17 == 0 else len(text or "")))
    out += [(7, "a tie", "en", "hot", 5), (7, "a tie", "en", "hot", 5), (8, "another\ntie", "fr", "hot", 11), (None, "no id\n", "en", "hot", 6),
            (None, None, None, None, None), (None, None, None, None, None), (1000, "word and word.\n" * 20_000, "en", "lone", 300_000),
            (1001, "x" * 1_000_000, "en", "long", 1_000_000)]
    return [(*r, "clash", "clash", 1, 2) for r in out]


@pytest.fixture(scope="module")
def rows():
    return documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


# --- 11 Merkle manifest

def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def siblings_of(levels, i):
    out = []
    for level in levels[:-1]:
        run = i // 3 * 3
        out.append((level[run:i], level[i + 1:run + 3]))
        i //= 3
    return out


def brute_manifest(rows):
    groups = collections.defaultdict(list)
    for doc_id, text, lang, source, n_chars, *_ in rows:
        leaf = altered = digest(*map(field, (doc_id, source, lang, n_chars, text)))
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
            altered = digest(*map(field, (doc_id, source, lang, n_chars, None if text is None else text.replace("\n", ""))))
        groups[source].append((doc_id is not None, doc_id or 0, leaf, doc_id, altered))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([g[2] for g in sorted(groups[s], key=lambda g: g[:3])]) for s in names}
    top, out = levels_of([trees[s][-1][0] for s in names]), []
    for at, s in enumerate(names):
        for i, (_, _, leaf, doc_id, folded) in enumerate(sorted(groups[s], key=lambda g: g[:3])):
            path = siblings_of(trees[s], i) + siblings_of(top, at)
            proof = digest(*[d for a, b in path for d in a + b])
            for a, b in path:
                folded = digest(*a, folded, *b)
            out.append((doc_id, leaf, trees[s][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def manifest_rows(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in merkle.verified_rows(df).collect()), key=repr)


def test_manifest_matches_brute_force(docs, rows):
    got = manifest_rows(docs)
    assert got == brute_manifest(rows)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 244])
def test_manifest_of_one_source(spark, n):
    rows = [(i, f"text\n{i}", "en", "only", i, "", "", 0, 0) for i in range(n)]
    got = manifest_rows(spark.createDataFrame(rows, SCHEMA))
    assert got == brute_manifest(rows)
    if n == 1:
        assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == digest()


def test_manifest_of_single_document_sources(spark):
    rows = [(i, f"text {i}", "en", None if i == 0 else f"s{i:03}", i, "", "", 0, 0) for i in range(250)]
    assert manifest_rows(spark.createDataFrame(rows, SCHEMA)) == brute_manifest(rows)


def test_manifest_of_empty_table(spark):
    assert merkle.verified_rows(spark.createDataFrame([], SCHEMA)).collect() == []


def test_records_name_their_children(docs):
    made = merkle.manifest(docs)
    stored = {r["digest"]: r["children"] for r in merkle.records(made.groups).collect()}
    stored |= {r["digest"]: r["children"] for r in merkle.records(made.top).collect()}
    assert all(digest(*c) == d and 1 <= len(c) <= 3 for d, c in stored.items())
    seen, open_nodes = collections.Counter(), [made.root]
    while open_nodes:
        node = open_nodes.pop()
        children = stored.get(node)
        open_nodes += children or []
        seen[node] += children is None
    leaves = collections.Counter(r["leaf"] for r in made.leaves.collect())
    assert {d: n for d, n in seen.items() if n} == dict(leaves)


def test_requests_for_some_leaves_and_a_lost_record(docs):
    made = merkle.manifest(docs)
    some = made.leaves.where(F.col("doc_id") % 50 == 3).select("g", "pos", "doc_id")
    every = {(r["g"], r["pos"]): (r["digest"], r["path"]) for r in merkle.proofs(made).collect()}
    got = merkle.proofs(made, some).collect()
    assert len(got) == 6 and all(every[r["g"], r["pos"]] == (r["digest"], r["path"]) for r in got)
    folded = merkle.proofs(made, some).select(merkle.fold(F.col("digest"), F.col("path")).alias("r")).distinct().collect()
    assert [r["r"] for r in folded] == [made.root]
    made.groups.tiers[0] = made.groups.tiers[0].where("pos > 0")
    with pytest.raises(Exception, match="record of the manifest is missing"):
        merkle.proofs(made).collect()


def test_manifest_sql_on_awkward_rows(spark, rows):
    import pandas as pd
    kept = [r[:5] for r in rows if r[0] != 1001]            # DuckDB walks ids as text; the long text adds nothing
    frame = pd.DataFrame(kept, columns=["doc_id", "text", "lang", "source", "n_chars"]).astype(
        {"doc_id": "Int64", "n_chars": "Int64"})
    con = duckdb.connect()
    con.register("documents", frame)
    got = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({SQL['op11_merkle_manifest']})").fetchall()
    assert sorted(got, key=repr) == brute_manifest(kept)


# --- 12 embedding whitening

VECTORS = "vec_id long, embedding array<float>, n int, component string, x string"


def vectors(n, dim, scale, seed=0):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, dim)) * scale).astype(np.float32)


def brute_whitening(x):
    distinct = np.unique(x, axis=0)
    n, total = len(distinct), distinct.sum(axis=0)
    centred = distinct - total / n
    v = centred.T @ centred / n
    e, q = np.linalg.eigh(v)
    return n, total, e[::-1], q[:, ::-1], np.trace(v)


def check_whitening(got, ids, x, k=4, close=1e-9):
    n, total, e, q, trace = brute_whitening(x)
    by = collections.defaultdict(list)
    for r in got:
        by[r["vec_id"], r["component"]].append(r)
    w = (x - total / n) @ q[:, :k] / np.sqrt(e[:k])
    for c in range(k):
        column = np.array([by[i, c + 1][0]["whitened"] for i in ids])
        assert min(np.abs(column - w[:, c]).max(), np.abs(column + w[:, c]).max()) < close
        assert all(r["explained"] == pytest.approx(e[c] / trace, rel=1e-9) for i in ids for r in by[i, c + 1])
    for i, row in zip(ids, x, strict=True):
        assert by[i, 1][0]["deviation"] == sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, total, strict=True))
    assert {(r["n"], len(by[r["vec_id"], r["component"]])) for r in got if r["vec_id"] in ids} == {(n, 1)}
    assert {r["identity_error"] < 1e-9 for r in got} == {True}


def test_whitening_matches_eigenvectors(spark):
    c = vectors(400, 12, np.linspace(3, 0.3, 12))
    c[300:] = c[5]                                          # a hot vector
    bad = [(-1, None), (-2, []), (-3, [None] + [1.0] * 11), (-4, [float("nan")] * 12), (-5, [float("inf")] + [0.0] * 11),
           (-6, [1.0] * 3), (-7, [3e38] * 12)]
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(c)] + bad
    df = spark.createDataFrame([(*r, 1, "clash", "clash") for r in rows], VECTORS).repartition(4)
    got = whitening.whiten(df).collect()
    x = np.floor(256 * c.astype(np.float64)).astype(np.int64)
    assert len(got) == 1600
    check_whitening(got, list(range(400)), x)


def test_whitening_of_equal_deviations_misses_none(spark):
    # axis-aligned points: the covariance is a multiple of the identity, four times over
    rows = [(2 * i + s, [float((1 if s else -1) * (j == i)) for j in range(5)]) for i in range(5) for s in (0, 1)]
    got = whitening.whiten(spark.createDataFrame([(*r, 1, "", "") for r in rows], VECTORS)).collect()
    assert {r["component"] for r in got} == {1, 2, 3, 4} and len(got) == 40
    assert all(r["explained"] == pytest.approx(0.2) and r["identity_error"] < 1e-9 for r in got)


def test_whitening_of_low_rank_and_ties(spark):
    c = np.outer(np.arange(30), [1.0, 2.0, -1.0])           # one direction only
    rows = [(i % 20, [float(v) for v in row]) for i, row in enumerate(c)] + [(None, [0.0, 0.0, 0.0])]
    got = whitening.whiten(spark.createDataFrame([(*r, 1, "", "") for r in rows], VECTORS)).collect()
    assert {r["component"] for r in got} == {1} and len(got) == 31
    assert all(r["n"] == 30 and r["explained"] == pytest.approx(1.0) for r in got)


def test_whitening_without_spread_or_rows(spark):
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).collect() == []
    same = spark.createDataFrame([(i, [1.0, 2.0], 1, "", "") for i in range(4)], VECTORS)
    assert whitening.whiten(same).collect() == []
    nothing = spark.createDataFrame([(1, None, 1, "", ""), (2, [], 1, "", "")], VECTORS)
    assert whitening.whiten(nothing).collect() == []


def test_deviations_beyond_a_long_are_null():
    x = np.array([[0, 0], [2 ** 40, 1]], np.int64)
    value, fits = whitening.deviations(x, 2, x.sum(axis=0))
    assert fits.tolist() == [False, False]
    value, fits = whitening.deviations(x // 2 ** 20, 2, (x // 2 ** 20).sum(axis=0))
    assert fits.all() and value.tolist() == [2 ** 40, 2 ** 40]


# --- 13 document fingerprints

def likeness(a, b):
    x, y = (collections.Counter(fingerprints.paragraphs((t or "").encode())) for t in (a, b))
    either = sum((x | y).values())
    return sum((x & y).values()) / either if either else 1.0


def in_order(rows):
    def tie(r):
        return r[1] or ""
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), tie(r)))


def test_edited_versions_match_brute_force(docs, rows):
    distinct = [r for r in rows if r[0] not in (7, 8) and r[0] is not None]
    got = fingerprints.edited_versions(docs.where("doc_id not in (7, 8)")).collect()
    assert len(got) == len(distinct)
    by = {r["doc_id"]: r for r in got}
    order = in_order(distinct)
    for i, r in enumerate(order):
        text, after = r[1] or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        out = by[r[0]]
        assert out["n_chars"] == len(text) and out["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert out["near_edited"] == pytest.approx(likeness(text, edited)) and out["near_next"] == pytest.approx(likeness(text, after))


def test_ties_missing_ids_and_one_document(docs, rows, spark):
    got = fingerprints.edited_versions(docs).collect()
    assert len(got) == len(rows)
    assert collections.Counter(r["doc_id"] for r in got) == collections.Counter(r[0] for r in rows)
    by_text = collections.defaultdict(set)
    for r in fingerprints.fingerprints(docs.select("doc_id", "text")).collect():
        by_text[r["doc_id"]].add(r["fingerprint"])
    assert all(r["fingerprint"] in by_text[r["doc_id"]] for r in got) and len(by_text[8]) == 2 and len(by_text[7]) == 2
    one = fingerprints.edited_versions(docs.where("doc_id = 1000")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0 and one[0]["n_chars"] == 300_000
    assert fingerprints.edited_versions(docs.where("doc_id = -1")).collect() == []


def test_equal_texts_have_equal_fingerprints(spark):
    df = spark.createDataFrame([(1, "a. b. c\nd"), (2, "a. b. c\nd"), (3, "a. b. c\ne"), (4, None), (5, ""), (6, " \n ")], "doc_id long, text string")
    f = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(df).collect()}
    assert f[1] == f[2] != f[3] and f[4] == f[5] == f[6] and len(set(f.values())) == 3


@pytest.mark.parametrize("apart", [0, 1, 5, 40, 3000])
def test_peeling_recovers_the_differing_digests(spark, apart):
    shared = [f"paragraph {i} of both" for i in range(50)] + ["twice"] * 2
    a = "\n".join(shared + [f"only here {i}" for i in range(apart)])
    b = "\n".join([f"only there {i}" for i in range(apart // 2)] + shared + ["twice"] * (apart > 0))
    df = spark.createDataFrame([(1, a, b), (2, None, a), (3, "", None)], "k long, left string, right string")
    got = {r["k"]: r for r in fingerprints.compare_versions(df, "left", "right", ("k",)).collect()}
    items = fingerprints.Items([a.encode(), b.encode()])
    x, y = (set(items.key[items.owner == i].view(np.int64).tolist()) for i in (0, 1))
    assert got[1]["only_a"] == sorted(x - y) and got[1]["only_b"] == sorted(y - x)
    assert got[1]["likeness"] == pytest.approx(len(x & y) / len(x | y))
    assert len(got[1]["only_a"]) == apart and (got[1]["cells"] == 24) == (apart < 10)
    assert got[2]["likeness"] == 0.0 and got[2]["only_b"] == sorted(x) and got[3]["likeness"] == 1.0


def test_queries_read_the_tables(spark):
    from stationlab.llm.queries import QUERIES
    from conftest import SF_SMALL
    assert QUERIES["op13_document_fingerprints"](spark, SF_SMALL).count() == 200
    first = QUERIES["op12_embedding_whitening"](spark, SF_SMALL).first()
    assert first["identity_error"] < 1e-4
