"""The corpus pipeline: each stage against what it promises, on its own input."""

import os
import random
import subprocess
import sys

import corpus_pipeline
from bizlens.llm import minhash, staging
from tests.llm.conftest import MESSY, table, words
from tests.llm.test_dedup import near_groups

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.dtypes
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert docs.dtypes == columns
            after = {r.doc_id: r.text for r in docs.collect()}
        if name == "language_id":
            assert after == {d: t for d, t in before.items() if t and any(c.isalpha() for c in t)}
        elif name == "line_dedup":
            assert set(after) == set(before)
            assert all(set(after[d].split("\n")) <= set(before[d].split("\n")) for d in after)
        elif name == "minhash_near_dedup":
            kept = {d for d, (_, _, keep) in near_groups(list(before.items()), corpus_pipeline.NEAR_PERCENT).items() if keep}
            assert after == {d: before[d] for d in kept} and len(kept) < len(before)
        elif name == "suffix_array_dedup":
            assert set(after) == set(before) and sum(map(len, after.values())) < sum(map(len, before.values()))
        else:
            pieces = docs.collect()
            assert {r.doc_id for r in pieces} == set(before)
            assert max(r.offset + r.length for r in pieces) <= 2048


def test_near_duplicates_from_eight_tenths(spark):
    """Also at lower percentages, keys and bits follow the percentage."""
    rnd = random.Random(21)
    rows = []
    for i in range(40):
        base = words(rnd, 150, 10 ** 6).split(" ")
        copy = list(base)
        for k in range(1 + i % 6):
            copy[10 + 12 * k] = f"edited{k}"
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(copy))]
    docs, gone = table(spark, rows), {}
    for percent in (85, 80, 50):
        kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF) if percent == 80 else minhash.keep_first(docs, percent)
        want = {d for d, (_, _, keep) in near_groups(rows, percent).items() if keep}
        assert {r.doc_id for r in kept.collect()} == want
        gone[percent] = len(rows) - len(want)
    assert gone[85] < gone[80] < gone[50]
    assert minhash.banding(85) == (24, 5) and minhash.most_bits(85) == 26


def test_a_run_leaves_its_stages_only(spark):
    def left():
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{staging.shared_dir(spark)}/llm")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        return {s.getPath().getName() for s in fs.listStatus(path)} if fs.exists(path) else set()

    before, tables = left(), {t.name for t in spark.catalog.listTables()}
    pieces = corpus_pipeline.run(spark, SF)
    names = sorted(n.rpartition("-")[0] for n in left() - before)
    assert names == sorted(f"pipeline-{name}" for name, _ in corpus_pipeline.STAGES)
    assert {t.name for t in spark.catalog.listTables()} == tables
    assert pieces.agg({"offset": "min"}).first()[0] == 0


def test_messy(spark, messy, empty):
    for docs, n in ((messy, len(MESSY)), (empty, 0)):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            assert docs.count() <= n or name == "best_fit_packing"


def test_the_rest_does_without(tmp_path):
    """Without the pipeline and its operators the entry still imports and has all other queries."""
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('bizlens.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "from bizlens import catalog\n"
        "assert set(e.queries()) == set(e.oracle_sql()) == set(catalog.queries()), len(e.queries())\n")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
