"""Operators of the llm subpackage against brute force, exact round trips and labelled documents."""

from __future__ import annotations

import os
import random
import sys
import time
from datetime import date, datetime

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowmark.llm import bpe, mixing, percentiles, quality, queries, survivors

DATA = "/root/testdata/sf0.001"
have_vocabulary = pytest.mark.skipif(not os.path.exists(bpe.VOCABULARY), reason="no vocabulary here")
have_data = pytest.mark.skipif(not os.path.exists(DATA), reason="no test data here")

READ = "reading_id bigint, tmc_code string, measurement_tstamp timestamp_ntz, speed double, k string, n int"
OUT = "output_id bigint, tmc_code string, obs_start date, obs_end date, observed_speed_p95_mph double, observed_speed_p99_mph double, p95 double, k string"


def readings(spark, rows):
    return spark.createDataFrame([(i, c, t, v, "x", 1) for i, (c, t, v) in enumerate(rows)], READ)


def test_multi_select_equals_numpy(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows, by = [], {}
    for c, n in (("A", 3000), ("b ", 40), ("C", 1), ("D", 2)):
        for _ in range(n):
            day = int(rng.integers(1, 4))
            v = float(np.round(rng.normal(50, 9), 0 if c == "A" else 3))
            rows.append((c, datetime(2025, 1, day, 5), v))
            if 0 <= v <= 120:
                by.setdefault((c.strip().upper(), day), []).append(v)
    rows += [("A", None, 5.0), (None, datetime(2025, 1, 1), 5.0), ("A", datetime(2025, 1, 1), None), ("A", datetime(2025, 1, 1), 255.0), ("A", datetime(2025, 1, 1), float("nan"))]
    spans = [("a", 1, 1), ("A", 1, 3), ("B", 1, 3), ("C", 1, 3), ("D", 1, 3), ("A", 3, 2), ("Z", 1, 2), (None, 1, 2), ("A", 1, 3)]
    outs = spark.createDataFrame([(i, c, date(2025, 1, a), date(2025, 1, b), 1.0, 1.0, 9.0, "q") for i, (c, a, b) in enumerate(spans)], OUT)
    for few, bits in ((1, 20), (1, 4), (16, 6), (10_000, 20)):  # rounds down to single candidates, many short runs in salts, some rounds, none
        monkeypatch.setattr(percentiles, "RUN_BITS", bits)
        got = {(r["k"], r["d0"], r["d1"], r["q"]): r["value"] for r in percentiles.span_percentiles(readings(spark, rows), outs, [0.0, 0.5, 0.95, 0.99, 1.0], few=few).collect()}
        base = (date(2025, 1, 1) - date(1970, 1, 1)).days - 1
        want = {}
        for c, a, b in {("A", 1, 1), ("A", 1, 3), ("B", 1, 3), ("C", 1, 3), ("D", 1, 3)}:
            xs = [v for day in range(a, b + 1) for v in by.get((c, day), [])]
            if xs:
                want |= {(c, base + a, base + b, q): float(np.quantile(xs, q)) for q in (0.0, 0.5, 0.95, 0.99, 1.0)}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_misfits_and_clashing_columns(spark):
    rows = [("A", datetime(2025, 1, 1, h), float(40 + h)) for h in range(20)]
    outs = spark.createDataFrame([(1, "a", date(2025, 1, 1), date(2025, 1, 1), 58.0, None, 0.0, "z"), (2, "A", date(2025, 1, 1), date(2025, 1, 2), None, 62.0, 0.0, "z"), (3, "A", date(2025, 1, 1), date(2025, 1, 1), None, None, 0.0, "z"), (4, None, date(2025, 1, 1), None, 1.0, 1.0, 0.0, "z")], OUT)
    got = percentiles.misfit_outputs(readings(spark, rows), outs).collect()
    assert [r["output_id"] for r in got] == [2] and got[0]["k"] == "z"
    assert percentiles.misfit_outputs(readings(spark, []), outs).count() == 0
    assert percentiles.misfit_outputs(readings(spark, rows), outs.limit(0)).count() == 0


def test_digest_merges_within_half_a_bin(spark):
    rng = np.random.default_rng(5)
    rows = [("A", datetime(2025, 1, int(rng.integers(1, 9))), float(rng.uniform(0, 120))) for _ in range(2000)]
    v = percentiles.clean_values(readings(spark, rows), "tmc_code", "measurement_tstamp", "speed", 0, 120)
    parts = percentiles.digest(v.where("day % 2 = 0")).unionByName(percentiles.digest(v.where("day % 2 = 1")))
    xs = sorted(r[2] for r in rows)
    for r in percentiles.digest_percentiles(parts, ["k"], [0.1, 0.5, 0.99]).collect():
        assert abs(r["value"] - xs[int(r["q"] * (len(xs) - 1))]) <= 0.25


PERF = "perf_id bigint, g string, mask int, layer string, iteration_no int, loaded_at timestamp_ntz, a double, b double"


def donors_by_hand(rows):
    groups = {}
    for r in rows:
        if r[1] is not None:
            groups.setdefault(r[1], []).append(r)
    out = {}
    for g, rs in groups.items():
        if len(rs) < 2:
            continue
        rs = sorted(rs, key=lambda r: (-(r[4] if r[4] is not None else -(10**9)), -(r[5] - datetime(1970, 1, 1)).total_seconds() if r[5] else float("inf"), r[0]))
        for i, f in ((6, "a"), (7, "b")):
            for r in rs:
                if r[i] is not None and r[i] >= 0:
                    out[g, f] = r[0]
                    break
    return out


def test_survivors_equal_the_policy(spark):
    random.seed(7)
    rows = []
    for i in range(600):
        g = random.choice([None, "x", *"abcdefgh"]) if i % 3 else "x"  # a hot group
        rows.append((i, g, 0, "l", random.choice([None, 1, 2, 3]), random.choice([None, datetime(2025, 1, random.randint(1, 3))]), random.choice([None, -1.0, 1.0]), random.choice([None, float("nan"), 2.0])))
    rows.append((1000, "single", 0, "l", 1, None, 1.0, 1.0))
    df = spark.createDataFrame(rows, PERF)
    args = {"group": ["g"], "fields": ["a", "b"], "trust": F.col("iteration_no"), "recency": F.col("loaded_at"), "row_id": "perf_id"}
    clean = [r[:7] + (None if r[7] is not None and r[7] != r[7] else r[7],) for r in rows]
    got = {(r["g"], r["field"]): r["row_id"] for r in survivors.field_donors(df, **args).collect()}
    assert got == donors_by_hand(clean)
    assert survivors.field_donors(df.limit(0), **args).count() == 0
    one = survivors.survivors(df, **args).where("g = 'x'").first()
    assert one["n_rows"] == sum(r[1] == "x" for r in rows) and one["a_layer"] >= 1


@have_vocabulary
def test_encoding_equals_the_library(spark):
    tiktoken = pytest.importorskip("tiktoken")
    t = bpe.transducer()
    own = tiktoken.Encoding("own", pat_str=r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+", mergeable_ranks=t.ranks, special_tokens={})
    random.seed(11)
    parts = ["a", "the ", " traffic", "  ", "\n", "\t", "-", "==", "é", "日本", "1", "2025", "😀", "'s", "don't", "<|endoftext|>", " ", "Q00P04", "aaaaaaa", "\x00", "̈"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 60))) for _ in range(400)] + ["a" * 200_000, " " * 5000, "", "=" * 3001, "ab" * 40_000]
    for x in texts:
        ids = t.encode(x)
        assert ids == own.encode_ordinary(x)
        assert bpe.decode(ids) == x
    small = bpe.Transducer({bytes((i,)): i for i in range(256)} | {b"ab": 256, b"abc": 257, b"bc": 258, b"cd": 259})
    for _ in range(300):
        w = "".join(random.choices("abcd", k=random.randint(1, 12)))
        assert [small.text_of[i] for i in small.word(w)] == small.merged(w.encode())


@have_vocabulary
def test_ids_of_empty_and_null_texts(spark):
    df = spark.createDataFrame([(1, "Traffic on I-66"), (2, ""), (3, None), (None, "x"), (4, "Traffic on I-66"), (5, "x" * 300_000)], "doc_id bigint, text string").withColumn("ids", F.lit(1))
    got = {r["doc_id"]: r["ids"] for r in bpe.encode_column(df).collect()}
    assert got[2] == got[3] == [] and got[1] == got[4] and len(got[None]) == 1 and len(got) == 6
    assert bpe.encode_column(df.limit(0)).count() == 0
    r = bpe.round_trip(df.withColumn("source", F.lit("s"))).first()
    assert r["n_texts"] == 6 and r["n_changed"] == 0


def test_decoder_handles_split_and_broken_bytes():
    text = "añ日😀x"
    d = bpe.Utf8Decoder()
    assert "".join(d.feed(bytes((b,))) for b in text.encode()) + d.close() == text
    for raw in (b"\xff", b"\xe6\x97", b"\xed\xa0\x80", b"\xf0\x9f\x98", b"a\xc0\xafb", b"\xf4\x90\x80\x80", b"\xe6a"):
        d = bpe.Utf8Decoder()
        assert d.feed(raw) + d.close() == raw.decode("utf-8", "replace")


def test_mixture_reaches_shares_within_caps(spark):
    random.seed(2)
    docs = [(i, s, random.randint(1, 40) if s != "empty" else 0, random.uniform(0.3, 1), 1) for i, s in enumerate(random.choices(["big", "mid", "small", "none", None, "empty"], [60, 25, 5, 5, 3, 2], k=3000))]
    df = spark.createDataFrame(docs, "doc_id bigint, source string, n_tokens bigint, weight double, bucket int")
    targets = spark.createDataFrame([("big", 0.5, 1, "e"), ("mid", 0.3, 3, "e"), ("small", 0.2, 4, "e"), ("absent", 0.1, 2, "e"), ("small", 0.2, 4, "e"), (None, 0.2, 4, "e")], "source string, target_share double, max_repeats int, size string")
    mix = mixing.mix_sources(df, targets)
    rows = mix.collect()
    size = {d[0]: d[2] for d in docs}
    tokens = {}
    for r in rows:
        tokens[r["source"]] = tokens.get(r["source"], 0) + r["repeats"] * size[r["doc_id"]]
        assert 1 <= r["repeats"] <= {"big": 1, "mid": 3, "small": 4}[r["source"]]
    assert len({r["doc_id"] for r in rows}) == len(rows)
    total = sum(tokens.values())
    assert all(abs(tokens[s] / total - w) < 0.01 for s, w in (("big", 0.5), ("mid", 0.3), ("small", 0.2)))
    # the bottleneck source gives every document as often as it may, another whole epochs before fractions
    assert {r["repeats"] for r in rows if r["source"] == "small"} == {4}
    mids = {r["repeats"] for r in rows if r["source"] == "mid"}
    assert max(mids) - min(mids) <= 1
    # exact: the prefix in ascending key
    big = sorted((d for d in docs if d[1] == "big"), key=lambda d: d[0])
    keys = {r["doc_id"]: r["key"] for r in df.where("source = 'big'").withColumn("key", mixing.sampling_key("doc_id", "weight", 17)).collect()}
    chosen = {r["doc_id"] for r in rows if r["source"] == "big"}
    if len(chosen) < len(big):
        assert max(keys[i] for i in chosen) < min(keys[d[0]] for d in big if d[0] not in chosen)
    report = {r["source"]: r for r in mixing.mixture_report(mix, targets).collect()}
    assert report["absent"]["tokens"] == 0 and abs(sum(r["share"] for r in report.values()) - 1) < 1e-9
    assert mixing.mix_sources(df.limit(0), targets).count() == 0


@have_vocabulary
def test_plain_pre_tokens_equal_the_general_ones():
    t = bpe.transducer()
    rng = random.Random(8)
    every = "".join(map(chr, range(128)))
    texts = [every * 2] + ["".join(rng.choice(" \n\t\x1c\x1f\x0b ab1'sdltve.,_" + every) for _ in range(rng.randint(1, 40))) for _ in range(5000)]
    assert all(t.plain_split(x) == t.any_split(x) for x in texts)


@have_vocabulary
def test_long_pre_tokens_keep_states_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "MOST_STATES", 50)
    with open(bpe.VOCABULARY, "rb"):
        t = bpe.transducer.__wrapped__()
    rng = random.Random(9)
    for word in ("".join(rng.choice("abcdefghijklmnopqrstuvwxyzäöü") for _ in range(4000)), "ab" * 3000, "é" * 500):
        assert list(t.word(word)) == bpe.transducer().encode(word) and len(t.keys) <= 60


LINES = {
    "prose": "The queue on the bypass reached the bridge at 6:45 and did not recover until 10:15.\nThat was confirmed by phone.",
    "list": "- Corvale Parkway\n- Jaswick Bypass\n- Kelford Expressway\n- check threshold",
    "table": "speed,volume,period\n38.9,6455,NT\n47.1,2282,PM\n44.6,6283,PM",
    "junk": "yvtoskP9Ekxm2N8Q2dAVmxn7GHtktGYQdqiZfsYtLMNCZo/sfCWgKMWJsJP8GzetjYkPMoaJxljxIQKjF/CpCxkrJdWXACZuesFBEtMpZQA3A7VHQYXBGQ",
}


def test_kinds_of_plain_cases():
    for kind, text in LINES.items():
        share = quality.line_kinds(text)
        assert max(share, key=share.get) == kind, (kind, share)
    got = quality.measures(pa.array([None, " \n ", "", "The queue, it's over.\nÉté 12"]))
    assert all(np.isnan(x[:3]).all() for x in got.values()) and got["n_words"][3] == 5 and got["end_punct_share"][3] == 0.5 and got["longest_word"][3] == 6
    assert quality.line_kinds("your report is ready " * 40)["junk"] > 0.9 * 840


def test_quality_edges(spark):
    rows = [(i, LINES["prose"], "en", "x") for i in range(30)] + [(100, LINES["junk"], "EN", "x"), (101, None, None, "x"), (102, "", "en-US", "x"), (103, "  \n", "und", "x"), (None, LINES["list"], "zz9", "x"), (104, "\n".join(f"{i * 7 % 91}.{i % 10},{i * 37 % 9973},PM" for i in range(20_000)), "en", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, kind string")
    got = {r["doc_id"]: r["kind"] for r in quality.unnatural_documents(df).collect()}
    assert got[100] == "junk" and got[104] == "table" and got[None] == "list" and 101 not in got and 102 not in got and 0 not in got
    assert quality.unnatural_documents(df.limit(0)).count() == 0


def test_repetition_of_any_period():
    """Copies with a period above 40 words, or of short paragraphs between blank lines, are junk; stock sentences in any order are not."""
    rng = random.Random(5)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "ru", "sta") for b in ("der", "ling", "mont", "ster", "vale")]
    long = " ".join(rng.choice(words) for _ in range(90)) + ". The road was closed."
    assert quality.line_kinds(" ".join([long] * 8))["prose"] == 0
    assert quality.line_kinds("\n".join([long] * 8))["prose"] == 0
    assert quality.line_kinds("\n\n".join(["The road was closed until noon."] * 12))["prose"] == 0
    stock = ["The queue on the bypass reached the bridge before noon.", "That was confirmed by phone.", "It did not recover until the evening and was cleared.", "The sensor at the junction sent no data for an hour.", "We have compared it with the last month."]
    share = quality.line_kinds(" ".join(rng.choice(stock) for _ in range(400)))
    assert share["prose"] == sum(share.values())
    twice = long + "\n\n" + LINES["prose"]
    assert quality.line_kinds(twice + "\n\n" + twice)["junk"] == 0


def test_markup_of_any_length():
    """Tags, cells and rule blocks count as markup however long they are, in time in proportion to the line."""
    rng = random.Random(6)
    style = "; ".join(" ".join(rng.sample(["the", "colour", "of", "queue", "is", "as", "it", "was", "on", "map", "bridge", "before"], 9)) for _ in range(12))
    prose = " The queue reached the bridge and was cleared."
    for mark in (f'<div style="{style}">', f".queue {{{style}}}", f"{{{{{style}}}}}", "a" * 30 + "-b" * 30 + f"{{{style}}}"):
        share = quality.line_kinds(mark + prose)
        assert share["junk"] == sum(share.values()), mark
    share = quality.line_kinds(f'<td data-note="{style}">4.5</td>')
    assert share["table"] == sum(share.values())
    for text in ("<a" * 200_000, "a{" * 200_000, "{{x " * 100_000, "<a " + "x " * 200_000, "a" + " " * 400_000, "a-" * 200_000):
        start = time.monotonic()
        for pattern in (quality._TAG, quality._CSS, quality._CELL):
            pattern.findall(text)
        assert time.monotonic() - start < 5


def test_kind_does_not_depend_on_other_documents(spark):
    """A third of the corpus is one list whose other statistics are ordinary: all copies come out, tails or not."""
    text = "- The queue reached the bridge.\n- That was confirmed by phone.\n- It did not recover until then."
    rows = [(i, LINES["prose"] + f" It was seen {i % 7} times.", "en") for i in range(200)] + [(1000 + i, text, "en") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    expected = {1000 + i: "list" for i in range(100)}
    assert {r["doc_id"]: r["kind"] for r in quality.unnatural_documents(df).collect()} == expected


def test_tails_decide(spark):
    """Without tails nothing comes out; what is usual in a corpus is not in its tails."""
    rows = [(i, LINES["prose"] + f" It was seen {i} times.", "en") for i in range(60)] + [(100, LINES["junk"], "en")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert [r["doc_id"] for r in quality.unnatural_documents(df).collect()] == [100]
    assert quality.unnatural_documents(df, tail=1e9).count() == 0
    stats = quality.document_statistics(df)
    tails = {r["doc_id"]: r["tails"] for r in quality.flag_tails(quality.robust_scores(stats, quality.statistic_sketches(stats))).collect()}
    assert "longest_word" in tails[100] and "common_share" in tails[100] and tails[5] == []
    weights = {r["doc_id"]: r["weight"] for r in quality.with_weight(df, ()).collect()}
    assert weights[5] == 1.0 and weights[100] < 0.5


def test_sketches_merge_to_quantiles(spark):
    df = spark.createDataFrame([(i, " ".join(["the"] * (i + 1)), "en") for i in range(500)], "doc_id bigint, text string, lang string").repartition(7)
    stats = quality.document_statistics(df)
    parts = [quality.statistic_sketches(stats.where(f"doc_id % 2 = {i}")) for i in (0, 1)]
    merged = {r["statistic"]: r for r in quality.sketch_quantiles(quality.merge_sketches(*parts)).collect()}
    whole = {r["statistic"]: r["at"] for r in quality.sketch_quantiles(quality.statistic_sketches(stats)).collect()}
    exact = quality.profile(np.arange(1, 501))
    assert merged["n_words"]["n"] == 500 and {k: r["at"] for k, r in merged.items()} == whole
    assert all(abs(a - b) <= 0.008 * (b + 1) + 1 for a, b in zip(whole["n_words"], exact))


@have_data
def test_labels_agree(spark):
    rows = queries.p10_agreement(spark, "/root/testdata/sf0.01").collect()
    good = sum(r["n_docs"] for r in rows if r["label"] == r["found"])
    assert good / sum(r["n_docs"] for r in rows) >= 0.97


@have_data
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_equal_sql(spark, name):
    sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
    import compare

    assert compare.same(queries.QUERIES[name](spark, DATA).toPandas(), compare.connect(DATA).sql(queries.SQL[name]).df()) == ""
