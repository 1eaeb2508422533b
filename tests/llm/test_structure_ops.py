"""Merkle manifest, conversation repair and quality rules: small blocks, brute force, hand-worked cases."""

import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tallyframe.llm import conversation_repair, merkle, quality_rules


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_root(digests):
    while len(digests) > 1:
        digests = [H(*digests[i : i + 2]) for i in range(0, len(digests), 2)]
    return digests[0]


@pytest.mark.parametrize("sizes", [[1], [2], [3, 1], [9, 4, 5], [33, 1, 17, 2, 8]])
def test_manifest_in_small_blocks(spark, monkeypatch, sizes):
    """Three levels a round: frontiers are dealt again, proofs come down in several rounds."""
    monkeypatch.setattr(merkle, "ROUND", 3)
    rows = [(1000 * g + i, f"g{g}", f"text {i}") for g, n in enumerate(sizes) for i in range(n)]
    random.Random(3).shuffle(rows)
    docs = spark.createDataFrame(rows, "id long, grp string, text string").repartition(5)
    made = merkle.manifest(docs, ["id", "text"], group="grp", key="id", id=F.col("id"))
    leaf = lambda r: H(f"{len(str(r[0]))}:{r[0]}", f"{len(r[2])}:{r[2]}")
    subs = [plain_root([leaf(r) for r in sorted(rows) if r[1] == f"g{g}"]) for g in range(len(sizes))]
    root = plain_root(subs)
    assert made.root() == root
    assert {r.tree: r.subroot for r in made.subroots.collect()} == {f"=g{g}": s for g, s in enumerate(subs)}
    proofs = made.proofs().withColumn("again", merkle.folded(F.col("digest"), F.col("proof")))
    assert {(r.id, r.digest) for r in proofs.collect()} == {(r[0], leaf(r)) for r in rows}
    assert {r["again"] for r in proofs.collect()} == {root}
    wrong = proofs.withColumn("again", merkle.folded(F.sha2(F.col("digest"), 256), F.col("proof")))
    assert root not in {r["again"] for r in wrong.collect()}


def test_manifest_names_changed_rows_only(spark, odd_docs):
    fields = ["doc_id", "text"]
    first = merkle.manifest(odd_docs, fields).root()
    assert merkle.manifest(odd_docs.repartition(3), fields).root() == first
    assert merkle.manifest(odd_docs.where("not doc_id <=> 5"), fields).root() != first
    assert merkle.manifest(odd_docs.limit(0), fields).root() is None


def brute_audit(signature):
    """The cheapest audit of all, by trying every edit of every turn with up to two inserts before it."""
    due = {"": ("u", "su"), "s": ("u", "u"), "u": ("a", "a"), "a": ("u", "u")}
    best = None
    edits = ["D", "R", "K"]
    for plan in itertools.product(*([("I" * k) + e for k in range(3) for e in edits] for _ in signature)):
        for end in range(3):
            cost, state, ok = 0, "", True
            letters = iter(signature)
            for e in "".join(plan) + "I" * end:
                if e == "I":
                    cost, state = cost + 5, due[state][0]
                    continue
                turn = next(letters)
                if e == "D":
                    cost += 2
                elif turn == "d" or (e == "K" and turn.lower() not in due[state][1]):
                    ok = False
                    break
                else:
                    cost += (5 if turn.isupper() else 0) + (e == "R")
                    state = turn.lower() if e == "K" else due[state][0]
            if ok and state in ("", "a"):
                found = (cost, "".join(plan) + "I" * end)
                best = found if best is None or found < best else best
    return best


@pytest.mark.parametrize("signature", ["s", "u", "a", "dd", "su", "sua", "au", "uU", "xA", "uua", "aua", "ssu", "Sua", "uad", "uxs"])
def test_audits_are_the_cheapest(signature):
    assert conversation_repair.finished(conversation_repair._solved(signature)) == brute_audit(signature)


def test_joined_halves_equal_one_pass():
    rnd = random.Random(5)
    for _ in range(30):
        s = "".join(rnd.choice("suaxdSUAX") for _ in range(rnd.randrange(2, 90)))
        plans = conversation_repair._step(s[0])
        for letter in s[1:]:
            plans = conversation_repair.joined(plans, conversation_repair._step(letter))
        assert plans == conversation_repair._solved(s)


def test_long_conversations_in_blocks(spark, monkeypatch):
    rnd = random.Random(7)
    rows = [(c, t, rnd.choice(["system", "user", "assistant", "tool"]), rnd.choice(["Fine.", "cut", " ", f"Text {t}."])) for c in range(4) for t in range(60)]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    whole = sorted(map(tuple, conversation_repair.audited(turns).collect()))
    monkeypatch.setattr(conversation_repair, "BLOCK", 7)
    assert sorted(map(tuple, conversation_repair.audited(turns).collect())) == whole
    edited = conversation_repair.Repair(turns).edited().collect()
    for c in range(4):
        lines = [f"{r.role}:{r.text}" for r in sorted((r for r in edited if r.conv == f"={c}"), key=lambda r: r.place)]
        assert H("\n".join(lines)) == next(r[-1] for r in whole if r[0] == f"={c}")
        roles = "".join(x[0] for x in lines)
        assert roles.removeprefix("s") == "ua" * (len(roles) // 2)


def test_repair_keeps_clear_of_other_columns(spark):
    rows = [(1, 1, "user", "Hi.", 9, 9, "x"), (1, 2, "assistant", "Yo.", 9, 9, "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, _place int, _size int, digest string")
    assert conversation_repair.audited(turns).first().audit == "KK"


def test_rules_are_weighed_by_agreement():
    """Two rules that agree and one that votes at random: the random one's accuracy is found to be poor."""
    rnd = random.Random(2)
    rows = {}
    for _ in range(5000):
        good = rnd.random() < 0.8
        vote = lambda right: (1 if good else -1) if rnd.random() < right else (-1 if good else 1)  # noqa: B023, E731
        key = (vote(0.97), vote(0.95), vote(0.96), rnd.choice([1, -1]), 0)
        rows[key] = rows.get(key, 0) + 1
    model = quality_rules.fit(sorted(rows.items()), 5)
    assert abs(model.share - 0.8) < 0.03
    assert min(model.on_good[:3]) > 0.93 and min(model.on_bad[:3]) > 0.9
    assert abs(model.on_good[3] - 0.5) < 0.05 and abs(model.on_bad[3] - 0.5) < 0.05
    assert model.evidence(0, 4) == 0


def test_rules_keep_good_and_reject_bad(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    told = quality_rules.judged(docs, carry=["doc_id"]).join(labels, "doc_id").collect()
    good = [r.kept for r in told if r.quality == 1 and not r.base_failed]
    bad = [r.kept for r in told if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.05 * len(bad)


def test_repeated_words_by_hand(spark):
    rows = [(1, "a b c d e a b c d e"), (2, "a a a a a a"), (3, "a b c d e f a b c d e g"), (4, "a b c d"), (5, None), (6, "x " * 50_000)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, _words int, kept int")
    told = quality_rules.judged(docs, carry=["doc_id", "_words", "kept"])
    assert told.columns[:2] == ["doc_id", "_words"]
    assert {r.doc_id: (r.n_words, r.n_repeat_words) for r in told.collect()} == {1: (10, 10), 2: (6, 6), 3: (12, 10), 4: (4, 0), 5: (0, 0), 6: (50_000, 50_000)}
