import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[4]")
             .appName("tokenweave-tests")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tw-test-ckpt-"))
    yield spark
    spark.stop()


def lengths_frame(spark, lengths):
    return spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)],
                                 "doc_id bigint, n bigint")


def formatted_plan(df) -> str:
    """``explain("formatted")`` as a string."""
    jvm = df.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def exchange_inputs(df) -> list[tuple[str, str]]:
    """(arguments, input columns) of every Exchange node of the formatted plan."""
    out, cur = [], None
    for line in formatted_plan(df).splitlines():
        if line.startswith("(") and ") Exchange" in line:
            cur = {"input": "", "args": ""}
            out.append(cur)
        elif line.startswith("(") and cur is not None:
            cur = None
        elif cur is not None and line.startswith("Input"):
            cur["input"] = line
        elif cur is not None and line.startswith("Arguments"):
            cur["args"] = line
    return [(c["args"], c["input"]) for c in out]
