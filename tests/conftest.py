import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from readloom.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "4g", spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def shuffled_rows(df):
    """Rows that shuffles of the query wrote."""
    df.collect()
    found, plans = 0, [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
        elif name.endswith("QueryStageExec"):
            plans.append(plan.plan())
        elif name == "ShuffleExchangeExec":
            found += plan.metrics().apply("shuffleRecordsWritten").value()
        plans += [plan.children().apply(i) for i in range(plan.children().size())]
    return found
