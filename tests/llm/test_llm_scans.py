"""License scan, token alignment and whitening against brute-force versions, and on odd rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import documents, importable, odd_rows  # noqa: F401

from salesmart.llm import alignment, bpe, license_scan, whitening

CLASH = "doc_id bigint, text string, n_words int, licenses string, row int, k1 int, kept int, block int, n_a int"


@pytest.fixture
def clashing(spark):
    """Documents whose other columns have names that the operators use."""

    def build(*rows):
        full = [(i, text, 7, "x", 8, 9, 10, 11, 12) for i, text, *_ in rows]
        return spark.createDataFrame(full, CLASH).repartition(3)

    return build


# License scan

def small_words(text):
    table = str.maketrans(license_scan.UPPER, license_scan.LOWER)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(table))


def base(text):
    found, places, labels = small_words(text), [], set()
    for label, phrase in license_scan.PHRASES:
        phrase = phrase.split()
        at = [i for i in range(len(found)) if found[i:i + len(phrase)] == phrase]
        places += at
        labels |= {label} if at else set()
    return (len(found), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(labels)))


def test_license_phrases_equal_brute_force(documents, workspace, odd_rows):  # noqa: F811
    draw = random.Random(3)
    parts = ["under the", "MIT", "license", "Apache License, Version 2", "CC BY-NC", "cc by", "nc", "\n",
             "under the mit license", "é", "K", "İ", "version 2", "the", "_"]
    rows = [(100 + i, " ".join(draw.choices(parts, k=draw.randrange(1, 40))), "s") for i in range(300)]
    rows += [(900, "cc by nc " * 4000, "s"), (901, "cc by nc " * 4000, "s"), *odd_rows]
    found = license_scan.digest(license_scan.scan(documents(*rows), workspace)).collect()
    assert Counter((r.doc_id, *r[1:6]) for r in found) == Counter((i, *base(t)) for i, t, _ in rows)
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) and 0 <= r.score <= 1
               and (r.score == 1 or not r.n_base) for r in found)


def test_notices_are_found_with_edits_and_told_apart(documents, workspace):  # noqa: F811
    draw = random.Random(4)
    filler = [f"w{i}" for i in range(500)]
    rows, expected = [], {}
    for n, (label, notice) in enumerate(license_scan.NOTICES):
        words = small_words(notice)
        for kind in range(4):
            own = list(words)
            at = len(own) // 2
            if kind == 1:
                own[at:at] = ["inserted"]
            if kind == 2 and len(own) > 12:
                del own[at]
            if kind == 3:  # half of it is no finding
                own = own[:len(own) // 2]
            text = draw.choices(filler, k=draw.randrange(60)) + own + draw.choices(filler, k=50)
            doc = 10 * n + kind
            rows.append((doc, " ".join(text), "s"))
            expected[doc] = label if kind < 3 else None
    found = {r.doc_id: r for r in license_scan.digest(license_scan.scan(documents(*rows), workspace)).collect()}
    for doc, label in expected.items():
        got = set(found[doc].labels.split(",")) - {""}
        assert label in got if label else found[doc].score < 1, (doc, label, got)
    whole = {doc: found[doc].labels for doc in expected if doc % 10 == 0}
    assert whole == {doc: expected[doc] for doc in whole}
    plain = [(i, " ".join(draw.choices("the of license software under version and to a is".split(), k=400)), "s")
             for i in range(200)]
    assert not any(r.labels for r in license_scan.digest(license_scan.scan(documents(*plain), workspace)).collect())


def test_scan_keeps_the_callers_columns(clashing, workspace):
    docs = clashing((1, "Released under the MIT License."), (1, "Released under the MIT License."), (2, None))
    found = license_scan.scan(docs, workspace)
    assert found.columns == [c for c in docs.columns if c not in ("n_words", "licenses")] + ["n_words", "licenses"]
    assert sorted((r.doc_id, r.row, r.k1, r.kept, r.block, r.n_words, len(r.licenses)) for r in found.collect()) == [
        (1, 8, 9, 10, 11, 5, 1), (1, 8, 9, 10, 11, 5, 1), (2, 8, 9, 10, 11, 0, 0)]
    assert license_scan.scan(docs.limit(0), workspace.child("none")).count() == 0


# Alignment

def by_hand(texts):
    """Alignment of all texts by the libraries and plain loops."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(bpe.default_vocabulary())
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=alignment.default_pieces())
    a_bytes = bpe.vocabulary(bpe.default_vocabulary(), False).bytes
    b_bytes = alignment.Pieces(alignment.default_pieces()).bytes
    made = []
    for text in texts:
        raw = (" " + (text or "")).encode()
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids
        b = second.encode(text or "")
        if not text or b"".join(map(a_bytes.get, a)) != raw or b"".join(b_bytes[n] for n in b) != raw:
            made.append((0, 0, [], []))
            continue
        i = j = a_end = b_end = 0
        links, groups, own = [], [], ([], [])
        while i < len(a):
            links.append((a[i], b[j]))
            x, y = a_end + len(a_bytes[a[i]]), b_end + len(b_bytes[b[j]])
            if x <= y:
                own[0].append(a[i])
                i, a_end = i + 1, x
            if y <= x:
                own[1].append(b[j])
                j, b_end = j + 1, y
            if x == y:
                groups.append("|".join(",".join(map(str, side)) for side in own))
                own = ([], [])
        made.append((len(a), len(b), groups, links))
    counts = Counter(pair for *_, links in made for pair in set(links))
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    return [
        (n_a, n_b, len(groups), len(links), ";".join(groups),
         sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links))
        for n_a, n_b, groups, links in made
    ]


def odd_texts():
    draw = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "a", "'s", "B", "é", "漢", "🙂", "<|endoftext|>", ".", "!", "1", "　",
             "\x1c", "​", "\x85", "'", "word", "<s>", "<unk>", "the", "ing", "▁"]
    texts = ["".join(draw.choices(parts, k=draw.randrange(30))) for _ in range(300)]
    return [*texts, None, "", " ", "   ", " a", "x" * 3000, " " * 3000, "a ▁ b", "the cat " * 3000]


@pytest.mark.parametrize("tokens_a_walk", [1, 7, 256])
def test_alignment_equals_brute_force(documents, workspace, odd_rows, tokens_a_walk, monkeypatch):  # noqa: F811
    monkeypatch.setattr(alignment, "WALK_TOKENS", tokens_a_walk)
    rows = [(i, text, "s") for i, text in enumerate(odd_texts())] + odd_rows
    found = alignment.align(documents(*rows), workspace)
    got = Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, r.n_best, r.count_sum)
                  for r in found.collect())
    assert got == Counter((i, *x) for (i, *_), x in zip(rows, by_hand([t for _, t, _ in rows])))


def test_walk_jumps_and_resolves():
    draw = np.random.default_rng(2)
    for size, density in ((1, 1.0), (40, 0.9), (400, 0.5), (3000, 0.99)):
        end = np.arange(1, size + 1)
        a = np.union1d(end[draw.random(size) < density], [size])
        b = np.union1d(end[draw.random(size) < density], [size])
        links = alignment.walk(a, b, np.array([0, len(a)]), np.array([0, len(b)]))
        merged = np.union1d(a, b)  # each stretch between two ends is one overlap
        assert links[0].tolist() == np.searchsorted(a, merged).tolist()
        assert links[1].tolist() == np.searchsorted(b, merged).tolist()


def test_alignment_keeps_the_callers_columns(clashing, workspace):
    docs = clashing((1, "some text"), (1, "some text"), (None, None))
    found = alignment.align(docs, workspace)
    assert sorted((r.doc_id or 0, r.kept, r.block, r.row, r.n_a > 0) for r in found.collect()) == [
        (0, 10, 11, 8, False), (1, 10, 11, 8, True), (1, 10, 11, 8, True)]
    assert alignment.align(docs.limit(0), workspace.child("none")).count() == 0


def test_alignment_query_gives_digests(spark, tmp_path):
    texts = odd_texts()
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    expected = {
        i: (*x[:4], *x[5:], hashlib.sha256(x[4].encode()).hexdigest() if x[4] else "")
        for i, x in enumerate(by_hand(texts))
    }
    assert {r[0]: tuple(r[1:]) for r in alignment.op12_alignment(spark, str(tmp_path)).collect()} == expected


# Whitening

def vectors(spark, rows, folder):
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, n int").repartition(3).write.parquet(
        f"{folder}/embeddings.parquet")
    return str(folder)


def test_whitening_equals_brute_force(spark, tmp_path):
    draw = np.random.default_rng(5)
    x = (draw.normal(size=(700, 40)) * np.linspace(0.2, 3, 40) @ draw.normal(size=(40, 40))).astype(np.float32)
    rows = [(i, v.tolist(), 7) for i, v in enumerate(x)]
    odd = [(None, x[0].tolist(), 7), (3, x[3].tolist(), 7), (800, None, 7), (801, [], 7), (802, [1.0] * 39, 7),
           (803, [None] * 40, 7), (804, [float("nan")] * 40, 7), (805, [float("inf")] * 40, 7)]
    found = whitening.op13_whitening(spark, vectors(spark, rows + odd, tmp_path)).toPandas()
    used = [*rows, *odd[:2]]
    grid = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v, _ in used])
    n, sums = len(grid), grid.sum(0)
    off = (n * grid - sums) / n
    values, turn = np.linalg.eigh(off.T @ off / n)
    values, turn = values[::-1], turn[:, ::-1]
    white = off @ turn[:, :32] / np.sqrt(values[:32])
    assert len(found) == n * 32 and (found.n == n).all()
    got = found.sort_values("component").groupby("component").whitened
    for k in range(32):
        np.testing.assert_allclose(
            np.sort(np.abs(got.get_group(k + 1))), np.sort(np.abs(white[:, k])), atol=1e-9)
    np.testing.assert_allclose(
        found.drop_duplicates("component").sort_values("component").explained, values[:32] / values.sum(), rtol=1e-9)
    assert found.identity_error.nunique() == 1 and found.identity_error[0] < 1e-10
    deviation = dict(zip([i for i, *_ in used], ((n * grid - sums) ** 2).sum(1)))
    assert all(deviation[i if i == i else None] == d for i, d in zip(found.vec_id, found.deviation))


def test_sums_of_large_numbers_are_exact(spark, tmp_path):
    draw = np.random.default_rng(6)
    x = np.stack([draw.normal(size=200) * 1e11, draw.normal(size=200) * 1e-1, draw.normal(size=200)], 1)
    folder = vectors(spark, [(i, v.tolist(), 7) for i, v in enumerate(x.astype(np.float32))], tmp_path)
    docs = spark.read.parquet(f"{folder}/embeddings.parquet")
    model = whitening.fit(docs.select(whitening.on_grid(docs.embedding).alias("x")))
    grid = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in x.astype(np.float32)]
    assert model.sums == [sum(column) for column in zip(*grid)]
    n = model.n
    exact = sum((n * row[0] - model.sums[0]) ** 2 for row in grid) / n**3
    assert abs(model.eigenvalues[0] / exact - 1) < 1e-12  # the other two are 10^10 times smaller
    assert (model.eigenvalues > 0).sum() >= 1
    found = whitening.whiten(docs, model, keep=["vec_id", "n"]).collect()
    for r in found:
        deviation = sum((n * c - s) ** 2 for c, s in zip(grid[r.vec_id], model.sums))
        assert r.deviation == (deviation if deviation <= whitening.LONG else None)


def test_jacobi_keeps_small_eigenvalues():
    draw = np.random.default_rng(7)
    b = draw.integers(-3, 4, (30, 12)).astype(float)
    scale = 10.0 ** -np.arange(12)
    v = b.T @ b * np.outer(scale, scale)
    values, turn = whitening.one_sided_jacobi(whitening.pivoted_cholesky(v))
    np.testing.assert_allclose(turn.T @ turn, np.eye(len(values)), atol=1e-12)
    np.testing.assert_allclose(np.linalg.norm(v @ turn - turn * values), 0, atol=1e-10 * values[0])
    assert (np.diff(values) <= 0).all()


def test_whitening_without_rows_spread_or_with_few_rows(spark, tmp_path):
    none = whitening.op13_whitening(spark, vectors(spark, [(1, None, 1)], tmp_path / "none"))
    assert none.count() == 0 and none.columns[-1] == "identity_error"
    same = whitening.op13_whitening(spark, vectors(spark, [(i, [1.0, 2.0], 1) for i in range(9)], tmp_path / "same"))
    assert same.count() == 0
    flat = [(i, [float(i), 5.0, 2.0 * i], 1) for i in range(9)]  # one direction only
    line = whitening.op13_whitening(spark, vectors(spark, flat, tmp_path / "line")).collect()
    assert {r.component for r in line} == {1} and abs(line[0].explained - 1) < 1e-12
    docs = spark.createDataFrame([(1, [1.0, 2.0], 3, 4), (2, [3.0, 0.0], 3, 4)],
                                 "vec_id int, embedding array<double>, deviation int, _x int")
    model = whitening.fit(docs.select(whitening.on_grid(docs.embedding).alias("x")))
    kept = whitening.whiten(docs, model)
    assert kept.columns == ["vec_id", "embedding", "_x", "n", "deviation", "whitened"]
    assert {(r.vec_id, r._x, r.n) for r in kept.collect()} == {(1, 4, 2), (2, 4, 2)}
