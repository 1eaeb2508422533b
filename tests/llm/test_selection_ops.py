"""Quality, mixing, sharding and the pipeline."""

import math
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyframe.llm import kd_sharding, mixing, quality, queries


def test_quality_holds_out(spark):
    """Fitted on labels of half the documents, judged on the other half."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    model = quality.train(docs, labels.where(half))
    held = quality.scored(docs, model).join(labels.where(~half), "doc_id")
    rows = [(0 if r.toxic else 1 if not r.quality else 2, r._expected_grade, r._p_good) for r in held.select("toxic", "quality", "_expected_grade", "_p_good").collect()]
    good = [p >= quality.KEEP for g, _, p in rows if g == 2]
    assert np.mean(good) > 0.95
    assert np.mean([p < quality.KEEP for g, _, p in rows if g == 0]) > 0.8
    means = [np.mean([e for g, e, _ in rows if g == k]) for k in range(3)]
    assert means[0] < means[1] < means[2]
    assert (np.diff(model.thresholds) >= 0).all()


def test_quality_of_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(4, 1, 0), (6, 1, 0), (10, 1, 0), (9, 0, 0), (12, 0, 1), (12, 1, 0), (None, 1, 1), (99, 0, 0), (7, None, None)], "doc_id long, quality int, toxic int")
    kept = quality.select_quality(odd_docs, labels)
    assert kept.columns == odd_docs.columns
    rated = quality.scored(odd_docs, quality.train(odd_docs, labels)).collect()
    assert len(rated) == odd_docs.count()
    assert all(0 <= r._p_good <= r._p_low <= 1 for r in rated)
    none = labels.limit(0)
    assert quality.select_quality(odd_docs, none).count() == odd_docs.count()
    assert quality.select_quality(odd_docs.limit(0), labels).count() == 0


def test_exponent_meets_its_targets(spark):
    tokens = [1_000_000, 90_000, 70_000, 5_000, 300]
    totals = spark.createDataFrame([(str(i), t, t // 100) for i, t in enumerate(tokens)] + [("empty", 0, 3)], "source string, tokens long, n long")
    shares = [t / sum(tokens) for t in tokens]
    assert mixing.exponent(totals, mixing.Mix(repetition=4.0)) == pytest.approx(brute.exponent(shares, 4.0), abs=1e-8)
    assert mixing.exponent(totals, mixing.Mix(repetition=1e9)) == 0.0
    a = mixing.exponent(totals, mixing.Mix(entropy=1.2))
    assert brute.entropy(shares, a) == pytest.approx(1.2, abs=1e-6)
    assert mixing.exponent(totals, mixing.Mix(entropy=99.0)) == 0.0
    assert mixing.exponent(totals, mixing.Mix(entropy=0.0)) == 1.0


def _mix_rows(spark, n=3000):
    sizes = {"a": 0.6, "b": 0.3, "c": 0.1}
    rows, i = [], 0
    for s, share in sizes.items():
        for _ in range(int(n * share)):
            rows.append((i, " ".join(["w"] * (1 + i % 9)), s, 7))
            i += 1
    return rows


def test_mixture_realises_its_weights(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 100)
    rows = _mix_rows(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, passes int")
    got = mixing.temperature_mix(docs, mixing.Mix(repetition=2.0)).collect()
    per, total = {}, {}
    for i, text, s, _ in rows:
        total[s] = total.get(s, 0) + len(text.split())
    for r in got:
        per[r.source] = per.get(r.source, 0) + r._tokens
    shares = [total[s] / sum(total.values()) for s in "abc"]
    a = brute.exponent(shares, 2.0)
    w = [p**a for p in shares]
    budget = max(p / x for p, x in zip(shares, w, strict=True))
    for s, x in zip("abc", w, strict=True):
        want = x * budget * sum(total.values())
        assert want - 1 <= per[s] <= want + 10  # the row that crosses the quota is taken
    assert {r.doc_id for r in got if r._epoch == 0} == set(range(len(rows)))
    assert all(r.passes == 7 for r in got)
    again = mixing.temperature_mix(docs.repartition(5), mixing.Mix(repetition=2.0)).collect()
    assert sorted((r.doc_id, r._epoch, r._block, r._slot) for r in got) == sorted((r.doc_id, r._epoch, r._block, r._slot) for r in again)


def test_mixture_within_a_budget(spark):
    docs = spark.createDataFrame(_mix_rows(spark), "doc_id long, text string, source string, passes int")
    got = mixing.temperature_mix(docs, mixing.Mix(entropy=1.0, budget=5_000.0))
    assert 5_000 - 3 <= got.agg(F.sum("_tokens")).first()[0] <= 5_000 + 30


def test_mixture_of_odd_rows(odd_docs):
    out = mixing.temperature_mix(odd_docs, mixing.Mix(repetition=1.5))
    rows = out.collect()
    assert set(odd_docs.columns) <= set(out.columns)
    assert sum(r._epoch == 0 for r in rows) == odd_docs.count()
    assert mixing.temperature_mix(odd_docs.limit(0), mixing.Mix(repetition=2.0)).count() == 0
    with pytest.raises(ValueError):
        mixing.temperature_mix(odd_docs, mixing.Mix())


def test_tokens_are_blank_separated_words(spark):
    df = spark.createDataFrame([(None,), ("",), (" \n",), ("a",), ("  a\tb\n\nc ",), ("a b",)], "t string")
    assert [r[0] for r in df.select(mixing.tokens_of(F.col("t"))).collect()] == [0, 0, 0, 1, 3, 1]


def _checked(rows, n_shards):
    by = {}
    for r in rows:
        by.setdefault(r._shard, []).append(r)
    assert all(sorted(x._slot for x in rs) == list(range(len(rs))) for rs in by.values())
    assert set(by) <= set(range(n_shards))
    return {s: sum(x._size for x in rs) for s, rs in by.items()}


def test_shards_are_near_equal(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = kd_sharding.shard(docs, shards=8).collect()
    assert len(rows) == docs.count()
    sizes = _checked(rows, 8)
    assert len(sizes) == 8 and max(sizes.values()) < 1.1 * min(sizes.values())
    where = {}
    for r in rows:
        assert where.setdefault(r.text, r._shard) == r._shard


@pytest.mark.parametrize("shards", [1, 3, 5])
def test_any_number_of_shards(spark, sf, shards):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert len(_checked(kd_sharding.shard(docs, shards=shards).collect(), shards)) == shards


def test_shards_by_target_bytes(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    total = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0]
    sizes = _checked(kd_sharding.shard(docs, target_bytes=math.ceil(total / 6)).collect(), 6)
    assert len(sizes) == 6


def test_more_shards_than_the_driver_keeps(spark, monkeypatch):
    monkeypatch.setattr(kd_sharding, "MOST_NODES", 4)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("octet_length(text) < 4000")
    sizes = _checked(kd_sharding.shard(docs, shards=37).collect(), 37)
    assert len(sizes) == 37 and max(sizes.values()) < 1.6 * min(sizes.values())
    few = docs.limit(20)
    assert len(kd_sharding.shard(few, target_bytes=1).collect()) == 20


def test_rows_of_hot_texts_are_spread(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "hot" if i % 3 else f"text {i} " * 40, "en", "s") for i in range(3000)], "doc_id long, text string, lang string, source string")
    want = {r.doc_id: (r._shard, r._size) for r in kd_sharding.shard(docs, shards=4).collect()}
    monkeypatch.setattr(kd_sharding, "HOT", 1)  # no text is hot
    assert {r.doc_id: (r._shard, r._size) for r in kd_sharding.shard(docs, shards=4).collect()} == want
    assert len({s for i, (s, _) in want.items() if i % 3}) == 1


def test_shards_of_odd_rows(odd_docs):
    out = kd_sharding.shard(odd_docs, shards=4)
    rows = out.collect()
    assert len(rows) == odd_docs.count() and [c for c in out.columns if c == "_slot"] == ["_slot"]
    _checked(rows, 4)
    assert kd_sharding.shard(odd_docs.limit(0), shards=4).count() == 0


def test_equal_rows_stay_in_one_shard(spark):
    docs = spark.createDataFrame([(i, "same", "en", "s") for i in range(50)], "doc_id long, text string, lang string, source string")
    assert len(_checked(kd_sharding.shard(docs, shards=4).collect(), 4)) == 1


def test_pipeline_stages_one_by_one(spark, sf):
    """Each stage is judged on its own input."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    stage = dict(corpus_pipeline.STAGES)
    kept = stage["quality_classifier"](spark, docs, sf)
    assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    near = {r.doc_id for r in stage["jaccard_join"](spark, docs, sf).collect()}
    assert near == {i for i, (_, c) in brute.components(rows, 5, 80, 100).items() if c == i}
    clean = {r.doc_id for r in stage["decontamination"](spark, docs, sf).collect()}
    assert clean == {i for i, v in brute.contamination(rows, bench).items() if not v[4]}
    mixed = stage["source_mixing"](spark, docs, sf)
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} == {i for i, _ in rows}
    sharded = stage["kd_sharding"](spark, docs, sf)
    assert sharded.columns == [*docs.columns, "size", "shard", "slot"] and sharded.count() == docs.count()


def test_near_copies_of_repeated_and_null_ids(spark, sf):
    base = [f"w{i}" for i in range(60)]
    a, near, other, third = " ".join(base), " ".join([*base, "x"]), " ".join(f"v{i}" for i in range(60)), " ".join(f"u{i}" for i in range(60))
    rows = [
        (3, a), (5, near), (5, other), (None, a), (None, third), (None, third), (None, third + " x"), (7, "One two"), (7, "one two"), (7, "one two"),
        (1, None), (1, None), (2, None), (None, None), (None, None), (1, " "),
    ]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, extra int")
    out = corpus_pipeline.drop_near_copies(spark, docs, sf)
    assert out.columns == docs.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    blank = [r for r in got if not (r[1] or "").strip()]
    assert sorted(map(str, blank)) == sorted(map(str, [(1, None), (2, None), (None, None), (None, None), (1, " ")]))
    full = [r for r in got if r not in blank]
    assert len(full) == 4 and {(3, a), (5, other)} < set(full)
    assert sorted(r[1].lower() for r in full if r[0] == 7) == ["one two"] and [r[1] in (third, third + " x") for r in full if r[0] is None] == [True]


def test_stages_of_odd_rows(spark, sf, odd_docs):
    """Every stage keeps extra columns, clashing names among them, and takes nulls, repeated rows and empty tables."""
    odd = odd_docs.withColumns({"shard": F.lit("x"), "size": F.lit("y"), "_tokens": F.lit(1), "_size": F.lit(2), "_p_good": F.lit(3)})
    odd = odd.unionByName(odd.limit(1).withColumns({"doc_id": F.lit(None).cast("long"), "text": F.lit(None).cast("string"), "source": F.lit(None).cast("string")}))
    n = odd.count()
    counts = {}
    for name, f in corpus_pipeline.STAGES:
        out = f(spark, odd, sf)
        if name == "kd_sharding":
            assert set(odd.columns) | {"shard", "size", "slot"} == set(out.columns) and len(out.columns) == len(set(out.columns))
        else:
            assert out.columns == odd.columns
        counts[name] = out.count()
        assert f(spark, odd.limit(0), sf).count() == 0
    assert counts["kd_sharding"] == n and n <= counts["source_mixing"] <= 2 * n
    assert counts["decontamination"] == n and 0 < counts["jaccard_join"] < n


def test_a_budget_beyond_the_limit_is_refused(spark):
    docs = spark.createDataFrame(_mix_rows(spark), "doc_id long, text string, source string, passes int")
    with pytest.raises(ValueError):
        mixing.temperature_mix(docs, mixing.Mix(repetition=2.0, budget=1e9))


def test_bindings_give_the_contracts_columns(spark, sf):
    """The registered queries against plain versions, column by column."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = queries.op9_kd_sharding(spark, sf)
    assert dict(rows.dtypes) == {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"}
    texts, slots = dict(docs), {}
    for r in rows.collect():
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(slots) == list(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    found = queries.op4_jaccard_join(spark, sf)
    assert [(c, t) for c, t in found.dtypes if c != "component_id"] == [("doc_id", "bigint"), ("n_shingles", "bigint")]
    want = brute.components(docs, 3, 90, 100)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == want
    ids = queries.op3_token_index(spark, sf)
    assert dict(ids.dtypes) == {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"} and ids.count() == len(docs)
    media = {r.doc_id: (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in queries.op6_media_sniffing(spark, sf).collect()}
    assert media == {i: brute.media(t) for i, t in docs}
    graded = queries.op5_quality_classifier(spark, sf)
    assert graded.count() == len(docs) and graded.where("keep is null or not (0 <= p_good and p_good <= p_low and p_low <= 1)").isEmpty()


def test_pipeline_runs(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.count() > 0 and {"doc_id", "shard", "slot"} <= set(out.columns)


#: Names that operators and stages use inside, or once used.
INSIDE = (
    "_tf_key", "_tf_source", "_tf_times", "_tf_id", "_tf_hash", "_tf_shard", "_tf_join", "_tf_own", "_tf_bucket", "_tf_rn", "_tf_base", "_tf_hot", "_tf_p", "_tf_open", "_tf_n", "_tf_passes", "_tf_extra", "_tf_s", "_tf_k",
    "_row", "key", "id", "at", "blank", "hash", "_text", "_place", "_size_", "c0", "passes", "tokens", "partial", "n", "w", "first", "b", "node", "cls", "comp",
)


def test_stages_keep_columns_of_any_name(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 60")
    wide = docs.select("*", *(F.concat(F.lit(f"{c}/"), "doc_id").alias(c) for c in INSIDE))
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, wide, sf)
        rows = kept.select("doc_id", *INSIDE).collect()
        assert rows, name
        assert all(r[c] == f"{c}/{r.doc_id}" for r in rows for c in INSIDE), name


def test_near_copies_and_repeats(spark, sf):
    """Copies under several ids, under none, repeated rows and blank ones: the smallest id's row stays once."""
    base = " ".join(f"w{i}" for i in range(200))
    near = base.replace("w100", "other")
    rows = [(5, base), (5, base), (9, base), (None, base), (7, near), (3, "alone in the world of texts"), (3, "alone in the world of texts"), (None, "no id here but words enough"), (None, "no id here but words enough"), (1, ""), (1, ""), (2, " \n"), (None, ""), (None, ""), (4, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id or 0, r.text or "") for r in corpus_pipeline.drop_near_copies(spark, docs, sf).collect()))
    assert got == sorted([(5, base), (3, "alone in the world of texts"), (0, "no id here but words enough"), (1, ""), (2, " \n"), (0, ""), (0, ""), (4, "")])
