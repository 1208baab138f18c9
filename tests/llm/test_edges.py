"""Rows that differ in a few columns only, helper names, long unbroken runs, and substring dedup against brute force."""

import collections
import pathlib
import re
import resource

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationlab.llm import binary_records, jaccard_join, mixing, pii, prefix_counts, quality_rules, substring_dedup, toxicity, word_tokens
from stationlab.llm.common import WordHashes, tokenizer_path


# --- substring dedup

def brute_spans(rows, min_words=substring_dedup.MIN_WORDS, report=substring_dedup.REPORT_WORDS):
    """doc -> (spans, least document that shares a chunk), by tuples of words; only the cuts are the operator's."""
    words = {d: (t or "").split() for d, t in rows}
    chunks, holders = {}, collections.defaultdict(set)
    for d, w in words.items():
        chunks[d] = []
        if len(w) >= min_words:
            cuts = substring_dedup.cut_points(WordHashes()([x.encode() for x in w])).tolist()
            for i, a in enumerate(cuts):
                b = next((c for c in cuts[i:] if c >= a + min_words), None)
                if b is not None:
                    chunks[d].append((a, b))
                    holders[tuple(w[a:b])].add(d)
    shared = {c for c, ds in holders.items() if len(ds) > 1}
    spans, short = collections.defaultdict(list), set()
    for d, w in words.items():
        mine = [(a, b) for a, b in chunks[d] if tuple(w[a:b]) in shared]
        got = substring_dedup.merged(np.array(mine)).tolist() if mine else []
        spans[d] = [s for s in got if s[1] - s[0] >= report]
        short |= {tuple(w[a:b]) for a, b in mine if not any(x <= a < y for x, y in spans[d])}
    windows = collections.defaultdict(set)
    for d, w in words.items():
        for a, b in chunks[d]:
            if tuple(w[a:b]) in short:
                for s in range(max(0, b - report), min(a, len(w) - report) + 1):
                    windows[tuple(w[s:s + report])].add((d, s))
    for places in windows.values():
        if len({d for d, _ in places}) > 1:
            for d, s in places:
                spans[d].append([s, s + report])
    out = {}
    for d, s in spans.items():
        if s:
            first = min(min(holders[c]) for a, b in chunks[d] if (c := tuple(words[d][a:b])) in shared)
            out[d] = (substring_dedup.merged(np.array(s)).tolist(), first)
    return out


def test_repeated_spans_match_brute_force_with_three_and_more_holders(spark):
    rng = np.random.default_rng(8)

    def some(n, tag):
        return [f"{tag}{x}" for x in rng.integers(0, 10 ** 9, n)]
    rows = []
    for i in range(120):
        passage, around = some(26, "p"), some(30, "q")
        # the document in the middle holds the passage inside a longer one that a fourth shares
        texts = [some(20, "a") + passage + some(20, "b"), some(25, "c") + around + passage + some(15, "d"),
                 some(12, "e") + around + passage + some(9, "f"), some(30, "g") + passage + some(5, "h")]
        for k in rng.permutation(4)[:int(rng.integers(2, 5))]:
            rows.append((10 * i + int(k), " ".join(texts[k])))
    rows += [(5000, None), (5001, ""), (5002, "few words"), (5003, rows[0][1])]
    want = brute_spans(rows)
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, `__long` int, r_doc int").repartition(3)
    got = {r["doc_id"]: (r["spans"], r["first_doc_id"]) for r in substring_dedup.repeated_spans(docs).collect()}
    assert got == want and len(want) > 200
    left = substring_dedup.without_repeats(docs)
    assert left.columns == docs.columns and left.count() == len(rows)


def test_asked_digests_are_broadcast_by_bytes(spark):
    few = spark.createDataFrame([(1, [1, 2])], "id long, names array<long>")
    many = spark.range(20).select(F.col("id"), F.sequence(F.lit(1).cast("long"), F.lit(110_000).cast("long")).alias("names"))
    plans = [substring_dedup.bounded(d).join(spark.range(5), "id")._jdf.queryExecution().analyzed().toString() for d in (few, many)]
    assert ["broadcast" in p for p in plans] == [True, False]


# --- Jaccard join and mixing: rows told apart by all columns

AWKWARD = "doc_id long, text string, source string, lang string, l_doc int, l_rid int, m_doc int"


def awkward(spark, extra=()):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text, "a", "en"), (1, text, "a", "de"), (1, text, "a", "de"), (2, text, "a", "en"), (3, "other words here " * 9, "b", None),
            (3, "other words here " * 9, "b", None), (None, None, None, None), *extra]
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], AWKWARD).repartition(3)


def test_one_row_of_each_component_is_kept_whatever_the_partitions(spark):
    runs = [sorted(map(tuple, jaccard_join.one_of_each(awkward(spark).repartition(n), 3, 90).collect()), key=repr) for n in (1, 4)]
    assert runs[0] == runs[1] and [r[0] for r in runs[0]] == [1, 3, None]


def test_at_a_hundred_percent_only_equal_sets_are_linked(spark):
    near = " ".join(f"word{i}" for i in range(39))
    docs = awkward(spark, [(9, near, "a", "en"), (10, near.upper(), "a", "en")])
    got = {r["doc_id"]: (r["component_id"], r["n_links"]) for r in jaccard_join.jaccard_components(docs, 3, 100).collect()}
    assert got == {1: (1, 0), 2: (1, 0), 3: (3, 0), 9: (9, 0), 10: (9, 0), None: (None, 0)}


def test_least_size_of_linked_sets():
    for percent in range(1, 100):
        n = jaccard_join.least_size(percent)
        assert 100 * n >= percent * (n + 1) and (n == 1 or 100 * (n - 1) < percent * n)


def test_mix_loses_no_row_that_differs_in_another_column(spark):
    docs = awkward(spark, [(100 + i, f"some text of its own number {i}", "a", "en") for i in range(30)])
    taken = {r["doc_id"]: r["t"] for r in mixing.pareto_mix(docs).groupBy("doc_id").agg(F.sum("taken").alias("t")).collect()}
    runs = [collections.Counter((r["doc_id"], r["lang"]) for r in mixing.mixed_documents(docs.repartition(n)).collect()) for n in (1, 4)]
    assert runs[0] == runs[1]
    words = {r["doc_id"]: len((r["text"] or "").split()) for r in docs.collect()}
    for d, n in words.items():
        assert sum(c for (i, _), c in runs[0].items() if i == d) * n == (taken[d] or 0)
    assert all(runs[0][1, x] <= 2 * n for x, n in (("en", 1), ("de", 2)))
    assert runs[0][1, "en"] + runs[0][1, "de"] >= 3         # each of the three rows is taken at least once
    assert runs[0][1, "de"] >= runs[0][1, "en"] >= 1


# --- long runs, bounded memories

RUNS = ["1" * 1_000_000, "a" * 1_000_000 + " x@y.org", "1." * 500_000, "a@" * 300_000 + "b.c", "1.1.1." * 100_000 + "7 x@y.z", "1" * 300_000 + "..1.1.1.1"]


def test_patterns_are_the_plain_ones():
    plain = {"email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
             "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")}
    rng = np.random.default_rng(4)
    for _ in range(8000):
        letters = list(["ab.@-+ ", "01.2 ", "9.@a ", "é@x.1\n"][rng.integers(4)])
        text = "".join(rng.choice(letters, int(rng.integers(0, 30))))
        for kind, pattern in plain.items():
            assert list(pii.pattern_matches(kind, text)) == [m.span() for m in pattern.finditer(text)], (kind, text)


def test_patterns_take_linear_time_on_unbroken_runs():
    import time
    start = time.process_time()
    found = [len(pii.base_spans(t)) for t in RUNS]
    assert time.process_time() - start < 20
    assert found == [0, 1, 125_000, 1, 75_001, 1]


def test_memories_hold_bounded_bytes():
    made = []
    memory = word_tokens.Memory(lambda k: made.append(k) or k * 2, most_bytes=100_000)
    for i in range(5000):
        assert memory[f"key{i}"] == f"key{i}" * 2
    assert len(memory) + len(memory.older) < 1500 and len(made) == 5000
    long = "x" * 1000
    assert memory[long] == memory[long] == long * 2 and made.count(long) == 2 and long not in memory
    hashes = WordHashes(most=100)
    words = [b"w%d" % i for i in range(80)] + [b"y" * 500]
    assert (hashes(words) == hashes(words)).all() and b"y" * 500 not in hashes.known and len(hashes(words)) == 81


def test_a_megabyte_without_a_space_does_not_fill_the_memories():
    import tokenizers
    text = ("abcdefghij" * 100_000 + " " + "Ünïcode" * 30_000).encode()
    table = prefix_counts.PrefixTable(tokenizer_path(prefix_counts.VOCABULARY))
    encoder = word_tokens.WordEncoder(tokenizer_path(binary_records.VOCABULARY))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    library = tokenizers.Tokenizer.from_file(tokenizer_path(prefix_counts.VOCABULARY))
    for _ in range(3):
        steps = table.steps(text)
        ids = encoder.encode(text)
    assert int(np.frombuffer(steps, prefix_counts.STEP).sum()) == len(library.encode(text.decode(), add_special_tokens=False).ids)
    assert len(ids) // encoder.width.itemsize == len(encoder.lib.encode(text.decode(), add_special_tokens=False).ids)
    assert sum(map(len, (table.pieces, table.parts, encoder.pieces, encoder.chunks))) < 100
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024 < 600
    assert quality_rules.repeated_words(text.split()) == 0


def test_rows_without_id_are_not_held_out(spark):
    docs = spark.createDataFrame([(None, "some text"), (4, "some text"), (5, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["t"] for r in docs.select("doc_id", toxicity.in_training(F.col("doc_id")).alias("t")).collect()}
    assert got[None] is True and None not in {got[4], got[5]}
    labels = spark.createDataFrame([(4, 1), (None, 0)], "doc_id long, toxic int")
    scored = toxicity.learn_and_score(docs, labels).collect()
    assert len(scored) == 3 and all(0 <= r["score"] <= 1 for r in scored)


@pytest.mark.parametrize("n", [0, 1])
def test_mix_of_few_rows(spark, n):
    docs = awkward(spark).limit(0) if not n else awkward(spark).where("doc_id = 2")
    assert mixing.mixed_documents(docs).count() <= 2 * n and mixing.mixed_documents(docs).columns == docs.columns


def disk_bytes(spark):
    """Bytes of the session's shuffle files and shared folder."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    shared = pathlib.Path(spark.sparkContext.getCheckpointDir().removeprefix("file:")).parent
    return sum(files.apply(i).length() for i in range(files.size())) + sum(f.stat().st_size for f in shared.rglob("*.parquet"))


def test_first_fragment_is_dealt_out_once_and_not_stored(spark):
    rng = np.random.default_rng(12)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 10 ** 6, 400))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    before = disk_bytes(spark)
    assert jaccard_join.one_of_each(docs, 5, 80).count() == 400
    # a third of the shingles, 16 bytes a row and once only; a second deal or a stored list takes over 8 more
    assert disk_bytes(spark) - before < 20 * 400 * 396 / 3
