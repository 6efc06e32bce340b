import ast
import inspect
import os
import random

import pytest

import corpus_pipeline
from ledgerlake.llm import queries

from . import brute

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {"doc_id", "text", "lang", "source", "n_chars"}


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A folder with documents and labels whose outcome is known."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    rng = random.Random(3)
    names = ["river", "stone", "walks", "under", "quiet", "green", "light", "often", "seven", "bread", "cloud", "north"]

    def prose(n):
        return " ".join(rng.choice(names) + rng.choice(names) for _ in range(n))

    shared = prose(60)
    rows = [(i, prose(rng.randrange(60, 140)), "en") for i in range(60)]
    rows += [(100 + i, rows[i][1] + " tail", "en") for i in range(5)]  # near copies
    rows += [(200 + i, prose(50) + " " + shared + " " + prose(50), "en") for i in range(4)]  # a repeated passage
    rows += [(300, "12 34 !!", "en"), (301, None, "en"), (302, "too few", "en")]
    rows += [(400 + i, " ".join(rng.choice(names).upper() + "!!" for _ in range(80)), "en") for i in range(30)]
    docs = spark.createDataFrame([(i, t, la, "s", len(t or "")) for i, t, la in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i < 400), 0) for i, *_ in rows], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    return folder, rows


def test_each_stage_against_plain_loops(spark, small, tmp_path):
    folder, rows = small
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()} if i < 4 else docs.collect())
        assert i == 4 or set(docs.columns) == COLUMNS
    clean = {i for i, *_ in rows if i < 300}
    assert set(kept[0]) == {i for i, *_ in rows} - {300, 301}
    assert set(kept[1]) == clean
    want = {k for k, _, least in brute.components(list(kept[1].items()), 5, 80) if k == least}
    assert set(kept[2]) == want == clean - set(range(100, 105))
    texts = list(kept[2].items())
    for (key, text), gone in zip(texts, brute.covered([t.encode() for _, t in texts], 200)):
        left = bytes(b for b, g in zip(text.encode(), gone) if not g)
        assert kept[3][key] == left.decode(errors="ignore")
    assert all(len(kept[3][200 + i]) < len(kept[2][200 + i]) for i in range(4))
    assert {r["doc_id"] for r in kept[4]} == want and sum(r["length"] for r in kept[4] if r["piece"] == 0) > 0


def test_run_is_the_stages_in_turn(spark, small):
    got = corpus_pipeline.run(spark, small[0])
    assert {r["doc_id"] for r in got.collect()} == {i for i, *_ in small[1] if i < 100 or 200 <= i < 300}


def test_empty_documents(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_nothing_else_imports_this_package():
    root = os.path.dirname(inspect.getfile(queries))
    library = os.path.dirname(root)
    for folder, _, files in os.walk(library):
        if folder.startswith(root):
            continue
        for name in (f for f in files if f.endswith(".py")):
            with open(os.path.join(folder, name)) as source:
                for node in ast.walk(ast.parse(source.read())):
                    modules = [node.module or ""] if isinstance(node, ast.ImportFrom) else \
                        [a.name for a in node.names] if isinstance(node, ast.Import) else []
                    assert not any(m.startswith("ledgerlake.llm") for m in modules)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not here")
def test_every_query_is_registered():
    numbers = sorted(int(name.split("_")[0][2:]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
