import pathlib
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from tidemark import schemas  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("work")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    return session


def rows_of(df):
    """Rows as a sorted list of tuples, for comparison as a bag."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def registration(ncid, **values):
    """A registration file row as a dict; everything not given is empty."""
    row = dict.fromkeys(schemas.REGISTRATION_COLUMNS, "")
    row.update(ncid=ncid, birth_year="1980", age_at_year_end="44", last_name=f"NAME {ncid}")
    row.update(values)
    return row


def participation(ncid, **values):
    row = dict.fromkeys(schemas.PARTICIPATION_COLUMNS, "")
    row.update(ncid=ncid, election_lbl="11/03/2020", voting_method="IN-PERSON")
    row.update(values)
    return row


def write_snapshot(path, rows, columns, encoding="latin-1"):
    """Write rows as a tab-separated snapshot file with a header."""
    lines = ["\t".join(columns)] + ["\t".join(str(r.get(c, "")) for c in columns) for r in rows]
    pathlib.Path(path).parent.mkdir(parents=True, exist_ok=True)
    pathlib.Path(path).write_bytes(("\n".join(lines) + "\n").encode(encoding))
    return str(path)
