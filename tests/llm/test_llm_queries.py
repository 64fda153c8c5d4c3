"""Every query of the subpackage on the smallest tables: SQL twins, row counts, and the pipeline by brute force."""

import brute
import pytest
from cases import frame, none, odd  # noqa: F401
from compare import connect, difference

import corpus_pipeline
from areascore.llm import minhash, quality
from areascore.llm.batches import documents, labels
from areascore.llm.queries import QUERIES, SQL
from areascore.scratch import release

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def clean(spark):
    yield
    release(spark)


@pytest.mark.parametrize("name", SQL)
def test_query_matches_sql(spark, name):
    con = connect(SF_DIR)
    assert difference(spark, con, QUERIES[name], SQL[name], SF_DIR) is None
    con.close()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_query_returns_a_row_for_each(spark, name):
    got = QUERIES[name](spark, SF_DIR)
    if name.startswith("op9"):
        assert got.count() == spark.read.parquet(f"{SF_DIR}/embeddings.parquet").count()
    elif not name.startswith("op1_"):
        assert got.count() == documents(spark, SF_DIR).count()
    else:
        assert got.select("doc_id").distinct().count() == documents(spark, SF_DIR).filter("trim(text) <> ''").count()


def test_registered():
    from __spark_entry__ import queries

    assert set(QUERIES) | {"pipeline"} <= set(queries())


def test_pipeline_by_brute_force(spark):
    docs = {r.doc_id: r.text for r in documents(spark, SF_DIR).collect()}
    scored = quality.quality_scores(documents(spark, SF_DIR), labels(spark, SF_DIR))
    good = [(r.doc_id, docs[r.doc_id]) for r in scored.collect() if r.predicted == 1]
    lines = brute.lines_left(good)
    left = [(d, lines[d][2]) for d, t in good if not lines[d][1] or brute.words(lines[d][2])]
    near = brute.near_groups(left, corpus_pipeline.NEAR_PERCENT)
    firsts = [(d, t) for d, t in left if near[d][2]]
    words = brute.without_windows(firsts, brute.words, 20)
    sizes = {d: sum(not gone for _, gone in p) for d, p in words.items()}
    stages = spark_stages(spark)
    assert sorted(r.doc_id for r in stages[0].collect()) == sorted(d for d, _ in good)
    assert {r.doc_id: r.text for r in stages[1].collect()} == dict(left)
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(d for d, _ in firsts)
    assert {r.doc_id: brute.words(r.text) for r in stages[3].collect()} == {
        d: [x for x, gone in p if not gone] for d, p in words.items()
    }
    for stage in stages[:4]:
        assert stage.columns == documents(spark, SF_DIR).columns
        assert stage.filter("n_chars <> length(text)").count() == documents(spark, SF_DIR).filter("n_chars <> length(text)").count()
    placed, filled = {}, {}
    for r in corpus_pipeline.run(spark, SF_DIR).collect():
        placed[r.doc_id] = placed.get(r.doc_id, 0) + r.n_words
        filled[r.bin_id] = filled.get(r.bin_id, 0) + r.n_words
    assert placed == {d: n for d, n in sizes.items() if n}
    assert max(filled.values()) <= 2048


def test_near_copies_from_080_up_leave_the_pipeline(spark):
    docs = []
    for i in range(40):
        base = [f"d{i}w{j}" for j in range(400)]
        docs.append((2 * i, " ".join(base)))
        changed = list(base)
        for at in range(20, 20 + 47 * (i % 8 + 1), 47):  # 1 to 8 changed words, five shingles each
            changed[at] = "edited"
        docs.append((2 * i + 1, " ".join(changed)))
    near = brute.near_groups(docs, 80)
    assert near != brute.near_groups(docs, 85)
    got = corpus_pipeline.drop_near_copies(spark, frame(spark, docs), SF_DIR)
    assert sorted(r.doc_id for r in got.collect()) == sorted(d for d, n in near.items() if n[2])
    assert {r[0]: tuple(r[1:]) for r in minhash.near_dedup(frame(spark, docs)).collect()} == brute.near_groups(docs)


@pytest.mark.parametrize("percent,bands", [(85, 25), (80, 37)])
def test_bands_follow_the_threshold(percent, bands):
    assert minhash.n_bands(percent) == bands
    assert (1 - (percent / 100) ** minhash.ROWS) ** bands < 1 / 2_000_000


def spark_stages(spark):
    from areascore.llm.batches import Kept

    keep, docs, out = Kept(spark), documents(spark, SF_DIR), []
    for name, stage in corpus_pipeline.STAGES:
        docs = keep(stage(spark, docs, SF_DIR), name.replace(" ", "-"))
        out.append(docs)
    return out


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_of_odd_rows(spark, odd, none, stage):
    got = stage(spark, odd, SF_DIR)
    if stage is not corpus_pipeline.STAGES[-1][1]:
        assert got.columns == odd.columns
    assert got.count() <= 10
    assert stage(spark, none, SF_DIR).count() == 0


def test_line_stage_takes_time_in_proportion(spark):
    """A text of 300,000 lines, most of them in repeated windows."""
    lines = [f"line {i % 70_000}" for i in range(300_000)]
    docs = frame(spark, [(1, "\n".join(lines)), (2, "\n".join(lines[:10])), (3, None)])
    got = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_lines(spark, docs, SF_DIR).collect()}
    assert got == {1: "\n".join(lines[:70_000]), 3: None}
