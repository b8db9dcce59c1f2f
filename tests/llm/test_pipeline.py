"""The pipeline's stages against brute force, each on its own input; and the queries' registry."""
import subprocess
import sys
from pathlib import Path

import corpus_pipeline as C
from conftest import SF_SMALL

from tidewatch.llm import encoding, quality, queries

from .test_decontaminate_jaccard import brute_components, brute_hits
from .test_dedup_warc import brute_dedup
from .test_tokens_packing import check_pieces

REPO = Path(__file__).resolve().parents[2]


def test_stages(spark, tmp_path):
    docs, got = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in C.STAGES:
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()] if "text" in docs.columns else []
        stage(spark, docs, SF_SMALL).write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        got[name] = (before, after)
        docs = after
        if name != "packing":
            assert docs.columns == columns
    ids = lambda name: sorted(r.doc_id for r in got[name][1].select("doc_id").collect())
    rows = got["quality_classifier"][0]
    source = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert ids("quality_classifier") == sorted(r.doc_id for r in quality.judge(source, quality.train(source)).where("keep").collect())
    assert len(rows) * 0.7 < len(ids("quality_classifier")) < len(rows)
    assert ids("exact_dedup") == sorted(d for d, _, _, kept, _ in brute_dedup(got["exact_dedup"][0]) if kept)
    assert ids("ngram_jaccard_join") == sorted(d for d, _, c in brute_components(got["ngram_jaccard_join"][0]) if d == c)
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    assert ids("benchmark_decontamination") == sorted(d for d, *_, hit in brute_hits(got["benchmark_decontamination"][0], items) if not hit)
    t = encoding.tokenizer(encoding.public())
    check_pieces(got["packing"][1].collect(), {d: [*t.library.encode(x or "", add_special_tokens=False).ids, 0] for d, x in got["packing"][0]})


def test_near_copies_between_80_and_85_percent(spark, docs_of):
    """Copies with new text appended go from a five-word similarity of 0.8 on."""
    rows, want = [], set()
    for g, new in enumerate([17, 18, 20, 22, 24, 25, 40]):
        base = [f"g{g}w{i}" for i in range(100)]
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(base + [f"g{g}n{i}" for i in range(new)]))]
        want |= {2 * g} if 96 / (96 + new) >= 0.8 else {2 * g, 2 * g + 1}
    assert len(want) == 9
    kept = {r.doc_id for r in C.near_copies_stage(spark, docs_of(rows), SF_SMALL).collect()}
    assert kept == want == {d for d, _, c in brute_components(rows, percent=80, k=5) if d == c}


def test_empty_documents(spark, tmp_path):
    for t in ("documents", "benchmark"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert C.run(spark, str(tmp_path)).collect() == []


def test_registry():
    import __spark_entry__ as E

    names = E.queries()
    assert [n for i in range(1, 11) for n in names if n.startswith(f"op{i}_")] == sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert names["pipeline"] is C.run and len(queries.QUERIES) == 10
    assert set(queries.ORACLE) <= set(names)


def test_entry_without_the_subpackage(tmp_path):
    """The entry point imports, with its other queries, where these folders are absent."""
    for p in ("__spark_entry__.py", "tidewatch"):
        (tmp_path / p).symlink_to(REPO / p) if p.endswith(".py") else None
    package = tmp_path / "tidewatch"
    package.mkdir()
    for p in (REPO / "tidewatch").iterdir():
        if p.name not in ("llm", "__pycache__"):
            (package / p.name).symlink_to(p)
    code = "import __spark_entry__ as E; q = E.queries(); E.oracle_sql(); print(len(q), any(n.startswith('op') for n in q), 'pipeline' in q)"
    run = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env={"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin:/bin"}, capture_output=True, text=True, timeout=120)
    assert run.stdout.split()[1:] == ["False", "False"], run.stderr[-500:]
