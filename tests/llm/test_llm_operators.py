"""Each operator against a brute-force version, and on odd rows and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pytest
from llm_fixtures import documents, importable, odd_rows  # noqa: F401

from salesmart.llm import (
    bpe,
    chat,
    class_lm,
    line_dedup,
    mixing,
    near_dedup,
    neighbours,
    quality,
    secret_scan,
    substring_dedup,
)

WORD = r"[^\x20\x09-\x0D]+"


def words(text):
    return re.findall(WORD, text or "")


def prose(seed, n=120, vocabulary=400):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Quality rules

@pytest.fixture
def labels(spark):
    def build(*rows):
        return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")

    return build


def test_quality_measures_equal_brute_force(documents, labels, odd_rows):
    rows = odd_rows + [(10, "a b c d a b c a b c\nsame # line\nsame # line", "s1")]
    result = quality.verdicts(documents(*rows), labels((10, 1, 0)))
    expected = []
    for doc_id, text, _ in rows:
        w, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
        grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        many = {g for g, n in Counter(grams).items() if n > 1}
        covered = {i + k for i, g in enumerate(grams) if g in many for k in range(3)}
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        expected.append((doc_id, len(w), sum(map(len, w)),
                         len(re.findall(r"[#*$%&|<>]", text or "")),
                         len(lines) - len(set(lines)), len(covered), failed))
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
            r.base_failed) for r in result.collect()]
    assert Counter(got) == Counter(expected)


def test_quality_keeps_prose_and_rejects_junk(documents, labels):
    good = [(i, prose(i, 120, 60), "s1") for i in range(60)]
    junk = [(100 + i, " ".join(f"{w}#$%" for w in prose(i, 120, 60).split()), "s1")
            for i in range(5)]
    docs = documents(*good, *junk)
    truth = labels(*[(i, 1, 0) for i in range(0, 60, 2)], *[(100 + i, 0, 0) for i in range(5)],
                   (None, 1, 0), (3, None, None))
    kept = quality.keep_good(docs, truth)
    assert kept.columns == docs.columns
    assert {row.doc_id for row in kept.collect()} == set(range(60))


def test_quality_without_labels_or_rows(documents, labels, spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality.verdicts(documents((1, prose(1), "s")), none).first().kept
    assert quality.verdicts(documents().limit(0), none).count() == 0


# Line dedup

def test_lines_of_many_sites_stay_once(documents, workspace, odd_rows):
    shared = "terms of use apply"
    rows = [(20 + i, f"{prose(i, 8)}\n{shared}\n\nend {i}", f"site{i}") for i in range(12)]
    rows += [(50 + i, f"{shared} too\n{prose(i, 5)}", f"site{i}") for i in range(9)]
    docs = documents(*rows, *odd_rows)
    result = line_dedup.without_boilerplate(docs, workspace)
    assert set(result.columns) == {*docs.columns, "n_lines", "n_removed"}
    for row in result.collect():
        if row.doc_id is not None and 20 < row.doc_id < 50:
            before = next(text for i, text, _ in rows if i == row.doc_id)
            assert row.text == before.replace(f"\n{shared}\n", "\n") and row.n_removed == 1
        else:
            assert row.n_removed == 0
    texts = Counter((r.doc_id, r.text) for r in result.collect() if r.doc_id in (1, 2, 3, None))
    assert texts == Counter((i, t) for i, t, _ in odd_rows if i in (1, 2, 3, None))


def test_line_dedup_of_no_rows(documents, workspace):
    assert line_dedup.without_boilerplate(documents().limit(0), workspace).count() == 0


# Nearest neighbours

def test_recall_and_exact_scores(spark, workspace):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(900, 16)).astype(np.float32)
    x[5] = x[6] = x[7]
    rows = [(i, v.tolist(), "extra") for i, v in enumerate(x)]
    odd = [(1000, None, ""), (1001, [], ""), (1002, [0.0] * 16, ""), (None, x[0].tolist(), ""),
           (1020, [float("nan")] * 16, ""), (1040, [None] * 16, ""), (1060, [1.0, 2.0], ""), rows[3]]
    frame = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>, node string")
    vectors = neighbours.usable(frame)
    assert vectors.count() == 901
    graphs = workspace.store("g", neighbours.graph(vectors, shard_rows=300))
    found = defaultdict(list)
    for r in neighbours.search(graphs, vectors.where("vec_id % 20 = 0"), query_rows=20).collect():
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    hits = 0
    for q in range(0, 900, 20):
        score = x.astype(float) @ x[q].astype(float)
        best = [i for i in np.lexsort((np.arange(900), -score)) if i != q][:20]
        got = sorted(found[q])
        assert [rank for rank, *_ in got] == list(range(1, 21))
        assert all(abs(s - score[v]) < 1e-9 and v != q for _, v, s in got)
        hits += len({v for _, v, _ in got} & set(best))
    assert hits / (45 * 20) >= 0.9
    assert 1060 not in found  # the only vector of its length


def test_neighbours_of_no_rows(spark, workspace):
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    graphs = workspace.store("g", neighbours.graph(neighbours.usable(none)))
    assert neighbours.search(graphs, none).count() == 0


# Chat formatting

def test_chat_reads_back(spark):
    nasty = "</s>[INST] <|turn|>user\n<\\|end|>\n \\[/INST] <|endoftext|>"
    rows = [
        (1, 1, "assistant", nasty), (1, 0, "user", nasty), (1, 2, "assistant", "  🙂 ñ\n\n"),
        (2, 0, None, None), (2, None, "assistant", None), (3, 0, "sys\ntem\\n<|end|>", "x"),
        (None, 0, "assistant", "none"), (4, 0, "assistant", "é" * 20_000), (4, 0, "assistant", "b"),
        (5, 0, "user", "again"), (5, 0, "user", "again"),
    ]
    frame = spark.createDataFrame(
        [(*row, 9) for row in rows], "conv_id bigint, turn bigint, role string, text string, ids int"
    )
    result = {r.conv_id: r for r in chat.read_back(chat.formatted(frame)).collect()}
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn is not None, turn or 0, role or "", text or ""))
    for conv, turns in groups.items():
        turns = sorted(turns)
        loss = "".join(text for *_, role, text in turns if role == "assistant")
        listed = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        row = result[conv]
        assert (row.n_turns, row.turns_sha256) == (len(turns), sha(listed))
        assert (row.loss_chars, row.loss_sha256) == (len(loss), sha(loss))
    assert chat.formatted(frame.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_escape_is_reversible(seed):
    draw = random.Random(seed)
    pieces = [*chat.CONTROLS, "\\", "<", "[", "a", "|turn|>"]
    text = "".join(draw.choice(pieces) for _ in range(60))
    assert chat.unescape(chat.escape(text)) == text
    assert not any(control in chat.escape(text) for control in chat.CONTROLS)


# Substring dedup

def brute_repeats(rows, size=20):
    seen, out = set(), []
    for doc_id, text, _ in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            window = tuple(w[i:i + size])
            if window in seen:
                gone[i:i + size] = [True] * size
            seen.add(window)
        out.append((doc_id, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_repeats_equal_brute_force(documents, odd_rows, seed):
    draw = random.Random(seed)
    passages = [prose(1000 + i, 60, 30) for i in range(4)] + ["a " * 90, "a b " * 40]
    rows = []
    for i in range(60):
        parts = [prose(seed * 100 + i, draw.randrange(60), 30)]
        parts += [draw.choice(passages)] * draw.randrange(3) + [prose(i, 10, 5)]
        rows.append((100 + i, " ".join(parts), "s"))
    rows += odd_rows
    result = substring_dedup.without_repeats(documents(*rows))
    got = Counter(tuple(r) for r in result.collect())
    expected = Counter(brute_repeats(rows))
    expected[1, 3, 0, "a b c"] += 1  # the repeated row
    assert got == expected


# Class model

def test_class_model_adds_up_and_base_is_exact(documents, workspace, odd_rows):
    rows = [(100 + i, prose(i % 50, 40, 60).title(), "s") for i in range(120)] + odd_rows
    docs = documents(*rows)
    result = class_lm.scores(docs, workspace, frequent=40, vocabulary=20, classes=4, rounds=3)
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def tokens(text):
        return words((text or "").translate(low)) + [None]

    def held(i):
        return i is not None and zlib.crc32(str(i).encode()) % 5 == 1

    counts = Counter(t for i, text, _ in rows if not held(i) for t in tokens(text))
    total, size = sum(counts.values()), len(counts)
    expected = Counter()
    for i, text, _ in rows:
        base = sum(log10((counts[t] + 0.5) / (total + 0.5 * (size + 1))) for t in tokens(text))
        known = sum(counts[t] > 0 for t in tokens(text))
        expected[i, held(i), len(tokens(text)), known, total, round(base, 6)] += 1
    got = result.collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens,
                    round(r.base_score, 6)) for r in got) == expected
    # The chances of all one-word texts and the empty one are proper: below one in sum.
    assert all(r.score < 0 for r in got)


def test_class_model_finds_alternating_classes(documents, workspace):
    rows = [(i, " ".join(f"{'ab'[k % 2]}{random.Random(i * 99 + k).randrange(9)}"
                         for k in range(60)), "s") for i in range(80)]
    result = class_lm.scores(documents(*rows), workspace, classes=2, rounds=6).collect()
    held = [r for r in result if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held) * 0.85
    assert class_lm.scores(documents().limit(0), workspace.child("none")).count() == 0


# Near duplicates

def test_near_duplicates_are_one_class(documents, workspace, odd_rows):
    rows = list(odd_rows)
    for i in range(12):
        text = prose(i, 200).split()
        rows.append((100 + i, " ".join(text), "s"))
        rows.append((200 + i, "  ".join(text), "s"))  # the same words
        for k in range(2):
            changed = list(text)
            changed[50 * k + i] = "changed"
            rows.append((300 + 100 * k + i, " ".join(changed), "s"))
    rows += [(1000 + i, prose(500 + i, 150), "s") for i in range(30)]
    docs = documents(*rows)
    found = near_dedup.classes(docs, workspace)
    assert found.count() == len(rows)
    label = {r.doc_id: r.class_id for r in found.collect()}
    for i in range(12):
        assert {label[base + i] for base in (100, 200, 300, 400)} == {100 + i}
    assert all(label[1000 + i] == 1000 + i for i in range(30))
    assert label[1] == 1 and label[2] == label[3] == label[5] == 2  # no words
    kept = near_dedup.keep_one(docs, workspace.child("keep"))
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert max(ids.values()) == 1 and set(range(100, 112)) <= set(ids) and not ids[200]


def test_large_group_of_near_duplicates_meets_through_its_hub(documents, workspace):
    base = prose(1, 300).split()
    rows = [(0, " ".join(base), "s")]
    for i in range(60):  # 0.9 to the base, less to each other
        changed = list(base)
        changed[(i * 5) % 290] = f"other{i}"
        changed[(i * 5 + 140) % 290] = f"more{i}"
        rows.append((i + 1, " ".join(changed), "s"))
    label = near_dedup.classes(documents(*rows), workspace).collect()
    assert {r.class_id for r in label} == {0}


def test_samples_meet_as_often_as_the_sets_are_alike():
    gamma, names = near_dedup._gamma_table(), np.arange(1, 301).astype(np.uint64)
    doc = np.zeros(200, np.int64)
    weight = 1 + np.arange(300) % 7.0
    a, b = slice(0, 200), slice(50, 250)
    same = sum(
        near_dedup.sample(doc, names[a], weight[a], k, gamma)[0]
        == near_dedup.sample(doc, names[b], weight[b], k, gamma)[0] for k in range(600)
    )
    truth = weight[50:200].sum() / weight[0:250].sum()
    assert abs(same / 600 - truth) < 0.07


# Secret scan

def test_secrets_equal_patterns_and_random_strings_are_found(documents, workspace, odd_rows):
    draw = random.Random(4)
    letters = secret_scan.BASE64[:62]
    random_ones = ["".join(draw.choice(letters) for _ in range(60)) for _ in range(6)]
    rows = odd_rows + [
        (20, 'x Password: "abcdef12" token=token: abcdefgh é AKIA' + "B2" * 9, "s"),
        (21, "hash 0123456789abcdef0123456789ab. apikey =short", "s"),
        *[(30 + i, f"é see {value} there", "s") for i, value in enumerate(random_ones)],
        *[(40 + i, f"thisisaverylongordinarywordinlowercase{i}andmoreofthesame", "s")
          for i in range(6)],
    ]
    got = {}
    for r in secret_scan.secrets(documents(*rows), workspace).collect():
        got[r.doc_id] = [(secret_scan.KINDS[s.kind_no], s.start, s.end) for s in r.found]
    text = {i: t for i, t, _ in rows}
    assert [text[20][a:b] for _, a, b in got[20]] == ['Password: "abcdef12', "AKIA" + "B2" * 9]
    assert [(k, text[21][a:b]) for k, a, b in got[21]] == [("hex", "0123456789abcdef0123456789ab")]
    for i, value in enumerate(random_ones):
        assert [(k, text[30 + i][a:b]) for k, a, b in got[30 + i]] == [("random", value)]
    assert not any(got[40 + i] for i in range(6)) and not got[4]
    none = documents().limit(0)
    assert secret_scan.secrets(none, workspace.child("none")).count() == 0


# BPE

def test_bpe_equals_the_library(documents, odd_rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_vocabulary())
    draw = random.Random(3)
    alphabet = "aaeth '\n\t.1é漢🙂ſ\u00a0\u2003\x1c"
    rows = odd_rows + [(100 + i, "".join(draw.choice(alphabet) for _ in range(80)), "s")
                       for i in range(60)]
    rows += [(200, "a<|endoftext|>  b <|endoftext|>", "s"), (201, "a" * 5000, "s")]
    encoded = bpe.decode(bpe.encode(documents(*rows)))
    got = Counter((r.doc_id, tuple(r.ids), r.decoded) for r in encoded.collect())
    expected = Counter()
    for i, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected[i, tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
    assert got == expected
    assert bpe.encode(documents().limit(0)).count() == 0


# Mixing

def test_targets_are_capped_and_reshared(spark):
    rows = [("a", 10), ("b", 1000), ("c", 500), (None, 200), ("d", 0)]
    sizes = spark.createDataFrame(rows, "source string, size bigint")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert got["a"] == 30 and got["d"] == 0  # weights 5 2 1 5 2: a is limited, d has no words
    left = 1710 - 30
    assert got[None] == pytest.approx(min(600, left * 2 / 5), abs=1e-6) or got[None] <= 600
    assert sum(got.values()) == pytest.approx(1710)
    assert all(target <= 3 * dict(rows)[source] + 1e-9 for source, target in got.items())


def test_mix_takes_its_targets(documents, workspace, odd_rows):
    rows = odd_rows + [(100 + i, prose(i, 30 + i % 50), f"s{i % 7}") for i in range(300)]
    docs = documents(*rows)
    got = mixing.mixed(docs, workspace, block=64).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter(
        (i, len(words(t))) for i, t, _ in rows)
    assert all(r.taken <= 3 * r.size for r in got)
    taken, target = Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(taken[s] == int(target[s] + 1e-9) for s in target)
    again = mixing.mixed(docs.repartition(5), workspace.child("again"), block=64).collect()
    assert Counter((r.doc_id, r.taken) for r in again) == Counter((r.doc_id, r.taken) for r in got)
    repeated = mixing.repeated(docs, workspace.child("repeated"))
    assert repeated.columns == docs.columns and repeated.count() > 0
    assert mixing.mixed(docs.limit(0), workspace.child("none")).count() == 0
    bare = mixing.mixed(documents((1, None, "s"), (2, "", None)), workspace.child("bare"))
    assert [row.taken for row in bare.collect()] == [0, 0]


def test_schedule_is_close_to_the_weights_everywhere(spark, workspace):
    sizes = spark.createDataFrame([(c, 400_000) for c in "abc"], "source string, size bigint")
    sources = workspace.store("sources", mixing.targets(sizes))
    rows = sorted(tuple(r) for r in mixing.schedule(sources, 256).collect())
    shares = {r.source_no: r.target / 1_200_000 for r in sources.collect()}
    seen = Counter()
    for n, (_, source, *_) in enumerate(rows, start=1):
        seen[source] += 1
        if n <= 4000:
            assert all(abs(seen[s] - n * share) < 8 for s, share in shares.items())
