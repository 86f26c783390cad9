"""All corpus queries with executors that do not have this repository."""

import subprocess
import sys
from pathlib import Path

from traitweave.llm.queries import queries

ROOT = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
from pyspark.sql import SparkSession

spark = (
    SparkSession.builder.master("local[6]")
    .config("spark.sql.shuffle.partitions", "3")
    .config("spark.driver.memory", "4g")
    .config("spark.sql.warehouse.dir", sys.argv[3])
    .config("spark.ui.enabled", "false")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
sys.path.insert(0, sys.argv[1])  # for the driver alone; workers are started without it

def there(batches):
    import importlib.util
    import pyarrow as pa
    for batch in batches:
        yield pa.RecordBatch.from_pydict({"there": [importlib.util.find_spec("traitweave") is not None]})

assert [r["there"] for r in spark.range(1).mapInArrow(there, "there boolean").collect()] == [False]

import corpus_pipeline
from traitweave.llm import queries

for name, query in {**queries.queries(), "pipeline": corpus_pipeline.run}.items():
    print(name, query(spark, sys.argv[2]).count(), flush=True)
"""


def test_workers_without_the_package(tmp_path, sf_dir):
    script = tmp_path / "run.py"
    script.write_text(SCRIPT)
    done = subprocess.run(
        [sys.executable, str(script), str(ROOT), sf_dir, str(tmp_path / "warehouse")],
        cwd=tmp_path,
        capture_output=True,
        text=True,
        timeout=1200,
        env={k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable},
    )
    assert done.returncode == 0, done.stdout[-2000:] + done.stderr[-4000:]
    counted = dict(line.split() for line in done.stdout.splitlines() if line.startswith(("op", "pipeline")))
    assert set(counted) == {*queries(), "pipeline"}
    assert all(int(n) > 0 for n in counted.values())
