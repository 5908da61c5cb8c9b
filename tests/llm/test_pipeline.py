"""The pipeline against plain Python over the same model, stage by stage on what the stage before kept."""

import math
import random
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from roadpulse.llm import exact_dedup, mixing, packing, quality_classifier, simhash
from roadpulse.llm.common import stored


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.fit(docs, labels)
    good = {r.doc_id for r in quality_classifier.score(docs, model).collect() if r.predicted}
    texts = {r.doc_id: r.text for r in docs.collect()}
    first = {}
    for i in sorted(good):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[i]), i)
    def shingles(text):
        words = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        words = re.findall(r"[^\x20\x09-\x0D]+", words)
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = {i: shingles(texts[i]) for i in first.values()}
    group = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if group[a] < group[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                    group[b], changed = group[a], True
    stay = {i for i in ids if group[i] == i}
    current, kept = docs, []
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, current, sf_dir)
        if name != "packing":
            assert result.columns == docs.columns
            current = stored(result, "test-stage")
            kept.append(Counter(r.doc_id for r in current.collect()))
    assert kept[0] == Counter(good) and kept[1] == Counter(first.values()) and kept[2] == Counter(stay)
    assert set(kept[3]) <= stay and max(kept[3].values()) <= 2
    words = {r.doc_id: 0 for r in current.collect()}
    for r in current.collect():
        assert r.n_chars == len(r.text) and r.text
        words[r.doc_id] += len(r.text.split())
    assert all(n <= 2 * len(texts[i].split()) for i, n in words.items())
    pieces = result.collect()
    assert {r.doc_id for r in pieces} == set(kept[3])
    assert len({(r.row, r.start) for r in pieces}) == len(pieces) and all(len(r.ids) == r.length for r in pieces)


def test_run_gives_the_packed_mix(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(got.columns) and got.count() > 0


def test_columns_of_any_name_stay(spark, tmp_path):
    """Rows and columns are the same whether or not a table has columns named like the stages' own."""
    names = ["__rid", "rid", "__row", "__pieces", "__n", "pieces", "key", "n", "row", "mixed", "good", "size", "node"]
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += rows[:5] + [(None, None, None, None, None), (900, "", "en", None, 0)]
    layout = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, layout).repartition(3).write.parquet(str(tmp_path / "plain"))
    plain = spark.read.parquet(str(tmp_path / "plain"))
    plain.selectExpr("*", *[f"'x' AS `{n}`" for n in names]).write.parquet(str(tmp_path / "named"))
    named = spark.read.parquet(str(tmp_path / "named"))
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    for run in (lambda d: quality_classifier.keep_good(d, labels), exact_dedup.drop_copies, simhash.drop_near_copies, mixing.mixed_documents):
        want, got = run(plain), run(named)
        assert got.columns == named.columns and want.columns == plain.columns
        got = got.collect()
        assert Counter(tuple(r)[:5] for r in got) == Counter(map(tuple, want.collect())) and all(set(tuple(r)[5:]) == {"x"} for r in got)
        assert run(named.limit(0)).count() == 0
    words = [mixing.taken_words(d).agg(F.sum("taken")).first()[0] for d in (plain, named)]
    assert words[0] == words[1] and exact_dedup.exact_groups(named).count() == len(rows)


@pytest.mark.parametrize("pairs", [60, 200])
def test_no_link_is_lost_behind_shared_page_furniture(spark, pairs):
    """100 words on every page and a tail of 14 words; the pages of a pair differ in the last two of these."""
    draw = random.Random(pairs)
    frame = [f"frame{i}" for i in range(100)]
    texts = []
    for k in range(pairs):
        tail = [f"t{k}x{draw.randrange(10**6)}" for _ in range(14)]
        texts += [" ".join(frame + tail), " ".join(frame + tail[:12] + [f"z{draw.randrange(10**9)}" for _ in range(2)])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.component_id, r.kept) for r in simhash.similar_groups(docs).collect()}
    sets = [{tuple(t.split()[i : i + 5]) for i in range(110)} for t in texts]
    assert len(sets[0] & sets[1]) >= 0.8 * len(sets[0] | sets[1]) and len(sets[0] & sets[2]) < 0.8 * len(sets[0] | sets[2])
    assert got == {i: (i - i % 2, i % 2 == 0) for i in range(2 * pairs)}


def test_scores_match_plain_python(spark):
    """The score from both dictionaries, text by text, with the library's compressor called the plain way."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    model = quality_classifier.fit(docs, labels)
    tools = quality_classifier.compressors(model.good, model.bad)
    rows = docs.collect()
    got = {r.doc_id: r for r in quality_classifier.score(docs, model).collect()}
    for r in rows:
        data = (r.text or "").encode()
        good, bad = (sum(len(t.compress(data[i : i + 1024])) for i in range(0, len(data), 1024)) for t in tools)
        ratio = min(good, bad) / len(data) if data else 0.0
        w = model.weights
        line = w[0] + w[1] * 10 * (bad - good) / max(good + bad, 1) + w[2] * ratio + w[3] * ratio**2
        assert got[r.doc_id].score == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, line)))))
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and got[r.doc_id].predicted == (got[r.doc_id].score >= 0.3)


def test_a_packing_worker_hands_on_few_ids_at_once(spark, monkeypatch):
    """What a worker waits with is bounded in ids, not in pieces; the ids are those of the texts, each once."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    runs = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: runs.append((self, run)))
    packing.pack(docs, packing.tokenizer_path())
    monkeypatch.undo()
    (base, run), = runs
    monkeypatch.setattr("pyspark.TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    out = list(run(iter(base.toArrow().to_batches())))
    assert max(sum(map(len, b.column("ids"))) for b in out) <= 1 << 18
    ids = {}
    for r in sorted((r for b in out for r in b.to_pylist()), key=lambda r: (r["rid"], r["start"])):
        assert len(ids.setdefault(r["rid"], [])) == r["start"]
        ids[r["rid"]] += r["ids"]
    want = {r.rid: [*packing.token_ids(r.text, packing.tokenizer_path()).tolist(), packing.END_ID] for r in base.collect()}
    assert ids == want and sum(map(len, want.values())) > 1 << 18
