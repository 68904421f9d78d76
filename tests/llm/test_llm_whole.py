"""Tests that the training-data operators do the whole job, not only its easy part."""

import random
from itertools import combinations

import numpy as np
from llm_fixtures import documents, importable  # noqa: F401

from salesmart.llm import class_lm, mixing, near_dedup, secret_scan


def test_pairs_that_meet_only_in_large_buckets_are_found(documents, workspace):  # noqa: F811
    draw = random.Random(8)
    template = [f"t{draw.randrange(10**6)}" for _ in range(300)]
    rows = []
    for pair in range(100):  # pairs of 0.82 in one template: 0.75 to all others, so no hub helps
        shared = [f"p{pair}x{k}" for k in range(3)]
        for side in range(2):
            own = [f"o{pair}x{side}x{k}" for k in range(6)]
            rows.append((2 * pair + side, " ".join(template + shared + own), "s"))
    found = near_dedup.classes(documents(*rows), workspace).select("doc_id", "class_id", "component")
    label = {r.doc_id: r.class_id for r in found.collect()}

    nodes = near_dedup._nodes(documents(*rows))
    idf = near_dedup.document_frequencies(nodes)
    texts = {r.doc_id: np.array(r.words, np.int64) for r in nodes.collect()}
    expected = {i: i for i in texts}
    links = [(a, b) for a, b in combinations(sorted(texts), 2)
             if near_dedup.weighted_jaccard(texts[a], texts[b], idf) >= near_dedup.SIMILAR]
    assert len(links) == 100 and all(b == a + 1 for a, b in links)
    expected |= {b: a for a, b in links}
    assert label == expected


def test_secrets_of_usual_length_are_found_among_many_ordinary_strings(documents, workspace):  # noqa: F811
    draw = random.Random(5)
    syllables = [a + b for a in "bcdfglmnprst" for b in "aeiou"] + ["ing", "tion", "er", "sh"]

    def ordinary():
        name = draw.choice(["_", "-", "/"]).join(
            "".join(draw.choices(syllables, k=draw.randrange(2, 6))) for _ in range(5))
        return f"{name}{draw.choice('_-/')}{draw.randrange(10 ** draw.randrange(1, 6))}"

    letters = secret_scan.BASE64[:62]
    lengths = [20, 24, 32, 40, 48, 64]
    planted = ["7a" + "".join(draw.choices(letters, k=lengths[i % 6] - 2)) for i in range(30)]
    plain = [ordinary() for _ in range(3000)]  # 1% secrets
    rows = [(i, f"see {value} there", "s") for i, value in enumerate(planted + plain)]
    found = secret_scan.secrets(documents(*rows), workspace).collect()
    reported = {r.doc_id for r in found if r.found}
    by_length = {n: sum(len(planted[i]) == n for i in reported if i < 30) for n in lengths}
    assert sum(by_length.values()) >= 29 and all(n >= 4 for n in by_length.values())
    assert len([i for i in reported if i >= 30]) <= 3


def test_words_outside_the_vocabulary_get_a_class(documents, workspace):  # noqa: F811
    rows = [(i, " ".join(f"{'ab'[k % 2]}{min(random.Random(i * 999 + k).sample(range(60), 2))}"
                         for k in range(60)), "s") for i in range(150)]
    docs = documents(*rows)

    def scored(name, **limits):
        result = class_lm.scores(docs, workspace.child(name), classes=2, rounds=6, **limits)
        return {r.doc_id: r for r in result.collect()}

    few = scored("few", vocabulary=10, frequent=40)
    held = [r for r in few.values() if r.held_out]
    gain = sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held)
    assert gain > 0.2  # of log10(2) = 0.3 by knowing which half of the words is next
    more = scored("more", vocabulary=10, frequent=1000)  # no word left for the join
    assert all(abs(r.score - more[i].score) < 1e-6 for i, r in few.items())
    assert all(abs(r.base_score - more[i].base_score) < 1e-6 for i, r in few.items())


def test_gains_of_rest_words_equal_the_objective():
    draw, classes, width = np.random.default_rng(3), 3, 5
    table = draw.integers(60, 90, (width, width)).astype(float)
    counts = draw.integers(0, 3, (4, 2 * width)).astype(float)
    counts[:, [*range(classes), *range(width, width + classes)]] = 0  # else a cell changes twice
    counts[:, [classes, width + classes + 1]] += 1
    word, at = np.nonzero(counts)
    got = class_lm.gains(word, at, counts[word, at], table, classes, 4)

    def objective(t):
        return sum(class_lm._xlogx(x).sum() * f for x, f in ((t, 1), (t.sum(0), -1), (t.sum(1), -1)))

    for i, (right, left) in enumerate(zip(counts[:, :width], counts[:, width:])):
        without = table.copy()
        without[classes] -= right
        without[:, classes] -= left
        alone = []
        for c in range(classes):
            moved = without.copy()
            moved[c] += right
            moved[:, c] += left
            alone.append(objective(moved))
        np.testing.assert_allclose(np.diff(got[i]), np.diff(alone), rtol=1e-6)


def test_the_mix_can_be_written_in_schedule_order(documents, workspace):  # noqa: F811
    draw, size = random.Random(2), {}
    for i in range(120):
        size[i] = draw.randrange(5, 60)
    docs = documents(*[(i, " ".join(["w"] * n), "abc"[i % 3]) for i, n in size.items()])
    mix = mixing.mixed(docs, workspace, block=16).collect()
    parts = mixing.in_order(docs, workspace.child("order"), block=16).collect()
    parts.sort(key=lambda r: (r.slot, r.source_no, r.place))
    taken, target = {}, {r.source: r.target for r in mix}
    for r in parts:
        assert 0 <= r.first and r.first + r.words <= size[r.doc_id] and r.words > 0
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.words
    assert taken == {r.doc_id: r.taken for r in mix if r.taken}
    for source in "abc":  # each stream comes whole and in order, at its weight anywhere
        own = [r for r in parts if r.source == source]
        assert [r.place for r in own] == [sum(x.words for x in own[:i]) for i in range(len(own))]
        half = parts[:len(parts) // 2]
        share = sum(r.words for r in half if r.source == source) / sum(r.words for r in half)
        assert abs(share - target[source] / sum(target.values())) < 0.05
