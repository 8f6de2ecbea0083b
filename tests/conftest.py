import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerstream.session import configure  # noqa: E402

DATA = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[*]").appName("tests")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.driver.memory", "4g")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return str(DATA)


@pytest.fixture
def transactions(spark):
    """Makes transactions from (account, amount, millis) or (account, amount, millis, type) rows."""
    def make(rows):
        full = [(str(i), r[3] if len(r) > 3 else 1, r[0], "b", float(r[1]), "memo", r[2]) for i, r in enumerate(rows)]
        return spark.createDataFrame(full, "id string, transaction_type_id int, account_id string, bank_id string, "
                                           "amount_transferred double, reason string, timestamp bigint")
    return make
