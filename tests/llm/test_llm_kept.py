"""What operators keep: the columns of the caller, and the exact words of the mix."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import importable  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from salesmart.llm import bpe, class_lm, line_dedup, mixing, near_dedup, quality

#: Names that operators give to columns on their way or to results of inner steps.
NAMES = ["_key", "_key2", "_row", "_node", "_node2", "_times", "_time", "_gone", "_list", "_bucket", "_words",
         "_text", "_doc_id", "_source", "_all", "_cut", "others", "copy", "slot", "words", "size", "place",
         "_quality", "component", "block", "ids.x", "`y`"]


@pytest.fixture
def crowded(spark):
    """Documents with columns of all these names; each holds a value that tells name and row."""

    def build(rows):
        frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
        frame = frame.withColumn("n_chars", F.length("text").cast("bigint"))
        values = [F.concat(F.lit(f"{name}/"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(name)
                  for name in NAMES]
        return frame.select("*", *values).repartition(3)

    return build


def untouched(found):
    """Every caller's column holds what it held."""
    rows = found.collect()
    for row in rows:
        for name in NAMES:
            assert row[name] == f"{name}/{'-' if row.doc_id is None else row.doc_id}", (name, row.doc_id)
    return rows


def prose(n, seed):
    return " ".join(f"w{(seed * 7919 + k * k * 31) % 613}" for k in range(n))


ROWS = [(i, prose(60 + i, i), f"s{i % 3}") for i in range(30)] + [
    (30, prose(60, 0), "s1"), (31, "line one\nline two", "s1"), (None, prose(70, 99), None), (None, None, "s2"),
    (40, "", "s2"), (41, " \n\t", None), (42, prose(9000, 5), "s0"),
]


def test_columns_of_the_caller_survive(crowded, spark, workspace):
    docs = crowded(ROWS)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id bigint, quality int, toxic int")
    steps = {
        "quality": lambda: quality.keep_good(docs, labels),
        "lines": lambda: line_dedup.without_boilerplate(docs, workspace.child("lines")),
        "near": lambda: near_dedup.keep_one(docs, workspace.child("near")),
        "mixing": lambda: mixing.repeated(docs, workspace.child("mix"), length="n_chars"),
        "bpe": lambda: bpe.encode(docs),
    }
    new = {"lines": ["n_lines", "n_removed"], "bpe": ["ids"]}
    for step, run in steps.items():
        found = run()
        assert found.columns == docs.columns + new.get(step, []), step
        assert untouched(found), step
    decoded = bpe.decode(bpe.encode(docs), text="back")
    assert all(r.back == (r.text or "") for r in untouched(decoded))
    gives_way = line_dedup.without_boilerplate(docs.withColumn("n_lines", F.lit("x")), workspace.child("way"))
    assert gives_way.columns == [*docs.columns, "n_lines", "n_removed"] and gives_way.schema["n_lines"].dataType.typeName() == "long"


def test_stages_of_the_pipeline_keep_columns(crowded, spark, tmp_path):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = crowded(ROWS)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, str(tmp_path))
        assert found.columns == docs.columns, name
        untouched(found)
        empty = stage(spark, docs.limit(0), str(tmp_path))
        assert empty.columns == docs.columns and empty.count() == 0, name


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_the_corpus_holds_exactly_the_words_taken(crowded, workspace):
    rows = [(i, prose(20 + i % 60, i), "abc"[i % 3]) for i in range(90)] + [(1, prose(21, 1), "b")] * 2 + ROWS[30:]
    docs = crowded(rows)
    mix = mixing.mixed(docs, workspace.child("a"), block=32).collect()
    found = mixing.repeated(docs, workspace.child("b"), block=32, length="n_chars").collect()
    taken, held, copies = Counter(), Counter(), defaultdict(list)
    for r in mix:
        taken[r.doc_id, r.source] += r.taken
    texts = {(i, s): t for i, t, s in rows}
    for r in found:
        own, whole = tokens(r.text), tokens(texts[r.doc_id, r.source])
        held[r.doc_id, r.source] += len(own)
        assert own == whole[:len(own)] and r.n_chars == len(r.text)
        copies[r.source].append(len(own) < len(whole))
    assert held == Counter({k: n for k, n in taken.items() if n})
    assert all(sum(cut) <= 1 for cut in copies.values())  # where a source's stream ends
    targets = {r.source: r.target for r in mix}
    for source, target in targets.items():
        assert sum(n for (_, s), n in held.items() if s == source) == math.floor(target + 1e-9)


def test_the_schedule_decides_the_mix(crowded, workspace, monkeypatch):
    docs = crowded([(i, prose(20 + i % 60, i), "abc"[i % 3]) for i in range(90)])

    def mix(name):
        rows = mixing.mixed(docs, workspace.child(name), block=32).collect()
        return {r.doc_id: (r.taken, r.first_slot, r.last_slot, r.n_parts) for r in rows}

    golden = mix("golden")
    assert mix("again") == golden
    assert all((parts == 0) == (first is None) == (taken == 0) for taken, first, _, parts in golden.values())
    parts = mixing.in_order(docs, workspace.child("order"), block=32).collect()
    for doc_id, (taken, first, last, n) in golden.items():
        own = [p for p in parts if p.doc_id == doc_id]
        assert (sum(p.words for p in own), len(own)) == (taken, n)
        assert (min((p.slot for p in own), default=None), max((p.slot for p in own), default=None)) == (first, last)
    monkeypatch.setattr(mixing, "GOLDEN", 1_234_567_891)
    other = mix("other")
    assert {i: x[0] for i, x in other.items()} == {i: x[0] for i, x in golden.items()} and other != golden


def test_class_scores_equal_plain_sums(crowded, spark, workspace):
    rows = [(i, " ".join(f"{'ab'[k % 2]}{(i * 31 + k * k) % (40 + i)}" for k in range(80)), "s") for i in range(80)]
    rows += [(100, None, "s"), (101, "", "s"), (None, "a1 b1 neverseen", "s"), (3, rows[3][1], "s")]
    docs = crowded(rows)
    limits = {"classes": 3, "rounds": 2, "vocabulary": 12, "frequent": 30}
    found = class_lm.scores(docs, workspace, **limits).collect()
    stored = spark.read.parquet(f"{workspace.folder}/classed").collect()
    never, end = 3, 4
    texts = defaultdict(list)
    for i, t, _ in rows:
        texts[i].append([w.lower() for w in tokens(t)])
    of, follow, seen, count = {}, Counter(), Counter(), Counter()
    for r in stored:
        words = texts[r.doc_id][0]
        assert len(words) == len(r.classes)
        of.update(zip(words, r.classes))
        if not r.held_out:
            follow.update(zip([end, *r.classes], [*r.classes, end]))
            seen.update([*r.classes, end])
            count.update(words)
    n_texts, total = seen[end], sum(seen.values())
    base_total = total + 0.5 * (len(count) + 1 + 1)
    unseen = 0.5 / base_total

    def step(a, b):
        if b == never:
            return unseen
        after = sum(follow[a, c] for c in range(5))
        chance = [(follow[a, c] + class_lm.SMOOTHING * (seen[c] + 1) / (total + 5)) / (after + class_lm.SMOOTHING)
                  for c in range(5)]
        return chance[b] * (1 - unseen) / (1 - chance[never])

    assert all(abs(sum(step(a, b) for b in range(5)) - 1) < 1e-12 for a in range(5))
    assert sum(not r.held_out for r in stored) == n_texts and len(found) == len(rows)
    for r in found:
        words = texts[r.doc_id][0]
        known = [w for w in words if count[w]]
        path = [end, *[of[w] if count[w] else never for w in words], end]
        score = sum(math.log10(step(a, b)) for a, b in zip(path, path[1:]))
        score += sum(math.log10(count[w] / seen[of[w]]) for w in known)
        assert abs(r.score - score) < 1e-8, (r.doc_id, r.score, score)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words) + 1, len(known) + 1, total)
        base = sum(math.log10((count[w] + 0.5) / base_total) for w in words) + math.log10((n_texts + 0.5) / base_total)
        assert abs(r.base_score - base) < 1e-8


def test_the_class_model_moves_neighbours_once_and_codes_packed(crowded, spark, workspace):
    rows = [(i, " ".join(f"w{(i * 31 + k * k * k) % 40}" for k in range(400)), "s") for i in range(300)]
    class_lm.scores(crowded(rows), workspace, classes=3, rounds=1, vocabulary=5, frequent=10).count()
    blocks = spark.read.parquet(f"{workspace.folder}/blocks")
    tokens = sum(len(t.split()) for _, t, _ in rows)
    assert blocks.agg(F.sum(F.octet_length("codes"))).first()[0] < 1.5 * tokens
    table = np.zeros((5, 5))
    rest = class_lm.rest_classes(blocks, None, None, table, 3)
    plan = rest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(word") == 1
    written = class_lm.placed(blocks, None)
    assert "word" not in written.columns and dict(written.dtypes)["codes"] == "binary"


@pytest.mark.parametrize("width", [6, 700])
def test_packed_numbers_and_sums_over_several_batches_are_whole(width):
    for values in ([], [0], [-1, 2**31 - 1, 5] * 1000):
        assert class_lm.unpacked(class_lm.packed(np.array(values, np.int64))).tolist() == values
    draw, expected = random.Random(5), Counter()
    sums, rows = class_lm.Sums(width), []
    for _ in range(5):  # blocks, after each of which the sums are passed on
        seen = Counter((draw.randrange(-4, 4) * 2**60, draw.randrange(width)) for _ in range(50))
        seen[2**62 + 1, width - 1] = 255 * draw.randrange(4) + draw.randrange(1, 3)
        expected.update(seen)
        pairs = np.array(list(seen), np.int64)
        sums.add(pairs[:, 0], pairs[:, 1], np.array(list(seen.values())))
        rows += sums.rows().to_pylist()
    rows.sort(key=lambda r: r["word"])
    schema = pa.schema({"word": pa.int64(), "beside": pa.binary()})
    got, words_found = Counter(), []
    for k in (1, 3, len(rows)):  # rows in a batch: a word goes on over many
        batches = [pa.RecordBatch.from_pylist(rows[i:i + k], schema) for i in range(0, len(rows), k)]
        for word, counts in class_lm.summed_up(iter(batches), width):
            words_found += word.tolist()
            for w, row in zip(word.tolist(), counts):
                got.update({(w, at): int(n) for at, n in enumerate(row) if n})
    assert got == Counter({key: 3 * n for key, n in expected.items()})
    assert len(words_found) == 3 * len(set(words_found))
    assert not list(class_lm.summed_up(iter([]), width))
