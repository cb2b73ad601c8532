"""The pipeline's stages, each judged on its own input, against brute force."""

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from helpers import docs_frame, jaccard_brute, repeats_brute, save, sha, words  # noqa: E402

import corpus_pipeline  # noqa: E402
from tessera.llm import bpe  # noqa: E402


def corpus():
    rnd = random.Random(21)
    stems = {"xx": ("ka", "lo", "mi", "su"), "yy": ("ré", "tra", "ne", "wi")}
    passage = words(rnd, 90)
    rows = []
    for i in range(120):
        lang = rnd.choice(["xx", "yy"])
        rows.append((i, words(rnd, rnd.randint(20, 120), stems[lang]), lang, rnd.choice(["a", "a", "a", "b", "c"])))
    rows += [(200 + i, rows[i][1], rows[i][2], "c") for i in range(5)]  # copies
    rows += [(300 + i, rows[i][1] + " ending", rows[i][2], "b") for i in range(20, 25)]  # near copies
    rows += [(400 + i, words(rnd, 150) + " " + passage + " " + words(rnd, 150), "xx", "a") for i in range(4)]  # a shared passage
    return rows + [(500, None, None, None), (501, "", "xx", "a"), (502, "12 ...", "yy", None)]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = save(docs_frame(spark, corpus()), tmp_path_factory.mktemp("corpus"), "documents")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, folder)
        out[name] = (docs, spark.read.parquet(save(result, folder, f"stage{i}") + f"/stage{i}.parquet"))
        docs = out[name][1]
    return folder, out


def as_rows(df):
    return [(r.doc_id, r.text, r.lang, r.source) for r in df.orderBy("doc_id").collect()]


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "substring_dedup", "source_mixing", "bpe"]
    for name, (before, after) in list(stages[1].items())[:-1]:
        assert after.schema.names == before.schema.names and after.dtypes == before.dtypes


def test_language_stage_drops_only_rejected(stages):
    before, after = stages[1]["language_id"]
    gone = {r[0] for r in as_rows(before)} - {r[0] for r in as_rows(after)}
    assert gone == {500, 501, 502}


def test_jaccard_stage_keeps_one_of_each_group(stages):
    before, after = stages[1]["jaccard_join"]
    rows = as_rows(before)
    _, label = jaccard_brute(rows)
    assert as_rows(after) == [rows[i] for i in sorted(set(label))]


def test_substring_stage_cuts_repeats(stages):
    before, after = stages[1]["substring_dedup"]
    rows = as_rows(before)
    want = repeats_brute([r[1] for r in rows], 200)
    assert any(w[1] for w in want)
    assert [r[1] for r in as_rows(after)] == [w[3].decode("utf-8", "ignore") for w in want]
    assert after.where("n_chars <> length(text)").count() == 0


def test_mixing_stage_repeats_small_sources(stages):
    before, after = stages[1]["source_mixing"]
    rows, drawn = as_rows(before), as_rows(after)
    assert set(drawn) == set(rows)
    count = lambda rs, s: sum(len(r[1].split()) for r in rs if r[3] == s)
    ratio = {s: count(drawn, s) / count(rows, s) for s in "abc"}
    assert ratio["a"] == 1 and max(ratio.values()) <= 1.25 and max(ratio.values()) > 1.0


def test_bpe_stage_equals_the_library(stages):
    before, after = stages[1]["bpe"]
    t = bpe.tokenizer(bpe.default_path())
    want = []
    for r in as_rows(before):
        ids = t.encode(r[1], add_special_tokens=False).ids
        want.append((r[0], len(ids), sha(",".join(map(str, ids)).encode()), sha(t.decode(ids, skip_special_tokens=False).encode())))
    assert sorted(map(tuple, after.collect())) == sorted(want)


def test_run_applies_all_stages(spark, stages):
    folder, out = stages
    got = sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()))
    assert got == sorted(map(tuple, out["bpe"][1].collect()))


def test_empty_table(spark, tmp_path):
    folder = save(docs_frame(spark, []), tmp_path, "documents")
    assert corpus_pipeline.run(spark, folder).count() == 0
