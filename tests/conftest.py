import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfcount.session import drop_copies, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "4g", **{
        "spark.sql.shuffle.partitions": "3",
        "spark.sql.codegen.wholeStage": "false",  # tiny inputs: compiling costs more than it saves
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    assert drop_copies(session) >= 0
    session.stop()


@pytest.fixture
def frame(spark):
    """rows and a DDL schema to a DataFrame"""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


ORGANIZATIONS = [
    ("n1", "us", 1.0, True, "n1"),
    ("n2", "us", 1.0, True, "n2"),
    ("n3", "us", 1.0, True, "n3"),
    ("n4", "us", 1.0, True, "parent"),
    ("n5", "ca", 1.0, True, "parent"),
    ("n6", "us", 3.0, True, "n6"),
    ("central", "us", 0.0, True, "central"),
    ("guest", "za", 0.0, False, "guest"),
]


@pytest.fixture
def organizations(frame):
    return frame(ORGANIZATIONS, "inst_id string, country_code string, weight double, "
                                "status boolean, mapto_inst_id string")


@pytest.fixture
def holdings(frame):
    """Holdings from (ocn, organization, enum_chron, status, condition, local_id, type)."""
    from shelfcount.functions.enum_chron import with_enum_chron

    def build(*rows):
        full = []
        for r in rows:
            ocn, org, enum, status, condition, local, kind = (*r, *(None, "", None, "", "b1", "mon")[len(r) - 1:])[:7]
            full.append((uuid.uuid4().hex, ocn, org, enum or "", status, condition, local, kind))
        return with_enum_chron(frame(full, "uuid string, ocn long, organization string, enum_chron string, "
                                           "status string, condition string, local_id string, "
                                           "mono_multi_serial string"))
    return build


@pytest.fixture
def items(frame):
    """Items from (cluster_id, item_id, bib_key, bib_fmt, enum_chron, rights, billing_entity, ocns)."""
    from shelfcount.functions.enum_chron import with_enum_chron

    def build(*rows):
        full = []
        for r in rows:
            row = list(r) + [None] * (8 - len(r))
            row[5] = row[5] or "ic"
            row[7] = row[7] or [int(row[2])]
            full.append((*row, "deny"))
        return with_enum_chron(frame(full, "cluster_id string, item_id string, bib_key long, bib_fmt string, "
                                           "enum_chron string, rights string, billing_entity string, "
                                           "ocns array<long>, access string"))
    return build


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted(tuple(r) for r in picked.collect())
