"""Repeated passages are verified on their words, also where different windows share a name."""

import random
from collections import defaultdict

import pytest
from llm_fixtures import documents, importable  # noqa: F401

from salesmart.llm import substring_dedup as dedup

SIZE = dedup.WINDOW


def corpus(seed):
    """Documents of few words that share passages, some in one document, some by a long copy."""
    draw = random.Random(seed)
    prose = [f"w{draw.randrange(200)}" for _ in range(4000)]
    rows = []
    for doc_id in range(40):
        words = []
        for _ in range(draw.randrange(1, 5)):
            start = draw.randrange(3800)
            words += prose[start:start + draw.randrange(5, 200)]
            words += [f"x{draw.randrange(10**6)}" for _ in range(draw.randrange(30))]
        rows.append((doc_id, " ".join(words), "s"))
    return rows + [(50, " ".join(prose), "s"), (51, " ".join(prose[64:]), "s"), rows[3],
                   (None, rows[5][1], "s"), (None, rows[5][1], "s")]


def removed(rows):
    """Words that each document loses, by plain search; the key is doc_id and text."""
    seen, gone = set(), defaultdict(set)
    for doc_id, text in sorted({r[:2] for r in rows}, key=lambda r: (r[0] is None, r[0] or 0)):
        words = text.split()
        for i in range(len(words) - SIZE + 1):
            window = tuple(words[i:i + SIZE])
            if window in seen:
                gone[doc_id, text].update(range(i, i + SIZE))
            seen.add(window)
    return gone


@pytest.mark.parametrize("block_words", [400_000, 300])
def test_claims_are_the_repeats(documents, block_words, workspace, monkeypatch):  # noqa: F811
    monkeypatch.setattr(dedup, "BLOCK_WORDS", block_words)
    rows = corpus(1)
    gone, texts = removed(rows), {dedup_key: text for dedup_key, text, _ in rows}
    found = workspace.store("claims", dedup.claims(documents(*rows)))
    covered = defaultdict(set)
    for c in found.collect():
        own, first = texts[c.doc_id].split(), texts[c.to_id].split()
        size = c.end - c.start
        assert own[c.start:c.end] == first[c.to_start:c.to_start + size]
        assert c.to_start // dedup.CELL == (c.to_start + size - 1) // dedup.CELL
        before = (c.to_id is None, c.to_id or 0, c.to_start) < (c.doc_id is None, c.doc_id or 0, c.start)
        assert before
        covered[c.doc_id, texts[c.doc_id]].update(range(c.start, c.end))
    assert covered == gone


@pytest.mark.parametrize("name_bits", [0, 5, 12])
def test_shared_names_remove_nothing_wrong(documents, workspace, name_bits):  # noqa: F811
    rows = corpus(2)
    gone = removed(rows)
    whole = {tuple(r) for r in dedup.without_repeats(documents(*rows), workspace.child("a")).collect()}
    expected = set()
    for doc_id, text, _ in rows:
        left = [w for i, w in enumerate(text.split()) if i not in gone[doc_id, text]]
        expected.add((doc_id, len(text.split()), len(gone[doc_id, text]), " ".join(left)))
    assert whole == expected
    few = dedup.without_repeats(documents(*rows), workspace.child("b"), name_bits=name_bits)
    for row in few.collect():
        text = next(t for i, t, _ in rows if i == row.doc_id and len(t.split()) == row.n_words)
        must_stay = [w for i, w in enumerate(text.split()) if i not in gone[row.doc_id, text]]
        left = iter(row.text.split())
        assert all(word in left for word in must_stay)  # in order
        assert row.n_removed <= len(gone[row.doc_id, text])


def test_no_rows(spark, workspace):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert dedup.without_repeats(none, workspace).count() == 0
