"""Accuracy on held-out rows, and rows that say nothing."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm.toxicity import ToxicityModel, features, strings

WORDS = "sun moon river tree stone cloud field bread water light door road lamp glass chair green quiet morning".split()
INSULTS = "grumblefool nitwittery blockheaded".split()


def corpus(n: int):
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(WORDS) + rng.choice(["", "s", "ing"]) for _ in range(rng.randint(10, 120))]
        toxic = int(i % 4 == 0)
        if toxic:
            for _ in range(1 + len(words) // 30):
                words[rng.randrange(len(words))] = rng.choice(INSULTS)
        docs.append((i, " ".join(words), "en", 0.25))
        labels.append((i, 1, toxic))
    return docs, labels


def test_held_out_rows_are_told_apart(spark):
    docs, labels = corpus(800)
    extra = [(9000, None, "en", 0.1), (9001, "", None, 0.1), (9002, "sun " * 50_000, "en", 0.1), (None, "moon", "en", 0.1), docs[3]]
    frame = spark.createDataFrame(docs + extra, "doc_id long, text string, lang string, score double").repartition(3)
    truth = spark.createDataFrame([*labels, (9000, None, None), (None, 1, 1), labels[8]], "doc_id long, quality int, toxic int")
    rows = ToxicityModel(spark, frame, truth).score(frame).collect()
    assert len(rows) == len(docs) + len(extra)
    by = {r.doc_id: r for r in rows}
    toxic = {i: t for i, _, t in labels}
    held = [i for i in toxic if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([by[i].predicted == toxic[i] for i in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert by[9000].score == by[9001].score and by[9000].predicted == by[9002].predicted == by[None].predicted == 0


def test_without_labels_nothing_is_toxic(spark):
    docs, _ = corpus(5)
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in ToxicityModel(spark, frame, none).score(frame).collect()} == {0}
    assert ToxicityModel(spark, frame.limit(0), none).score(frame.limit(0)).count() == 0


@pytest.mark.parametrize(
    "left_out",
    [lambda f, t: f == 4 and t, lambda f, t: f == 4 and not t, lambda f, t: f != 4 and t, lambda f, t: not t, lambda f, t: t],
    ids=["no toxic in fold 4", "only toxic in fold 4", "toxic only in fold 4", "only toxic", "only ordinary"],
)
def test_a_class_missing_in_a_fold(spark, left_out):
    docs, labels = corpus(400)
    folds = [zlib.crc32(str(i).encode()) % 5 for i in range(len(docs))]
    kept = [row for row in labels if not left_out(folds[row[0]], row[2])]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, score double").repartition(3)
    rows = ToxicityModel(spark, frame, spark.createDataFrame(kept, "doc_id long, quality int, toxic int")).score(frame).collect()
    if len({t for i, _, t in kept if folds[i]}) < 2:
        assert max(r.score for r in rows) < 1e-17
    else:
        assert np.mean([r.predicted == labels[r.doc_id][2] for r in rows if folds[r.doc_id] == 0]) > 0.9


def kneser_ney(texts: list[tuple[str, int]]):
    """Log ratio of any six-byte string, by dictionaries."""
    count, d = [Counter(), Counter()], 0.75
    for text, toxic in texts:
        for i in range(len(text)):
            count[toxic][(" " * 5 + text.lower())[i : i + 6]] += 1
    every = set(count[0]) | set(count[1])
    tail = Counter(g[3:] for g in every)
    context, kinds, byte = Counter(), Counter(t[:2] for t in tail), Counter()
    for t, n in tail.items():
        context[t[:2]] += n
        byte[t[2]] += n
    five, after = [Counter(), Counter()], [Counter(), Counter()]
    for c in (0, 1):
        for g, n in count[c].items():
            five[c][g[:5]] += n
            after[c][g[:5]] += 1

    def ratio(g: str) -> float:
        back = [d * after[c][g[:5]] / five[c][g[:5]] if five[c][g[:5]] else 1.0 for c in (0, 1)]
        if g not in every:
            return math.log(back[1] / back[0])
        p1 = (byte[g[5]] + 1) / (len(every) + 256)
        shared = (max(tail[g[3:]] - d, 0) + d * kinds[g[3:5]] * p1) / context[g[3:5]]
        own = [max(count[c][g] - d, 0) / five[c][g[:5]] if five[c][g[:5]] else 0.0 for c in (0, 1)]
        return math.log((own[1] + back[1] * shared) / (own[0] + back[0] * shared))

    return ratio


def test_every_string_has_its_own_ratio(spark):
    """Strings in the ten thousands, of which held-out rows share few: none may read another one's ratio."""
    rng = random.Random(11)
    letters = "abcdefghijkl"
    docs = []
    for i in range(240):
        words = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(20, 160))]
        if i % 4 == 0:
            words[rng.randrange(len(words))] = rng.choice(INSULTS)
        docs.append((i, " ".join(words)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in docs], "doc_id long, toxic int")
    model = ToxicityModel(spark, frame, labels)
    ratio = kneser_ney([(t, int(i % 4 == 0)) for i, t in docs if zlib.crc32(str(i).encode()) % 5 in (1, 2, 3)])
    got = {r.doc_id: r.score for r in model.score(frame).collect()}
    assert len(got) == len(docs)
    for i, text in docs:
        own = [ratio((" " * 5 + text)[k : k + 6]) for k in range(len(text))]
        best = max(sum(own[max(0, k - 23) : k + 1]) / 24 for k in range(len(own)))
        at = float(np.dot(model.weights, [1, np.mean(own), best, np.log1p(len(own))]))
        assert abs(got[i] - 1 / (1 + math.exp(-min(max(at, -40), 40)))) < 1e-3


def test_strings_do_not_cross_rows():
    data = np.frombuffer(b"ABcdefgABcdefg", np.uint8)
    key, lengths = strings(data, np.array([0, 7, 7, 14]))
    assert lengths.tolist() == [7, 0, 7] and key[:7].tolist() == key[7:].tolist()
    assert int(key[6]).to_bytes(6, "big") == b"bcdefg" and int(key[0]).to_bytes(6, "big") == b"     a"
    model = np.unique(key), np.arange(len(np.unique(key)), dtype=np.float32)
    both = features(model, data, np.array([0, 7, 7, 14]))
    assert both.shape == (3, 3) and both[0].tolist() == both[2].tolist() and both[0, 0] > 0 and not both[1].any()
