from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from statmart.registry import inline  # noqa: E402
from statmart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", **{
        "spark.checkpoint.dir": tmp_path_factory.mktemp("shared").as_uri(),
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """table(rows, schema) -> a small DataFrame."""
    return lambda rows, schema: inline(spark, rows, schema)


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    return sorted([tuple(r) for r in (df.select(*columns) if columns else df).collect()], key=repr)


@pytest.fixture(scope="session")
def crosswalk(table):
    lines = [
        ("ITA", "IT", "0", "Italia", "Italy", "", ""), ("ITC", "ITC", "1", "Nord-Ovest", "North-West", "", "Nord-Ovest"),
        ("ITH", "ITH", "1", "Nord-Est", "North-East", "", "Nord-Est"), ("01", "ITC1", "2", "Piemonte", "Piedmont", "Piemonte", "Nord-Ovest"),
        ("001", "ITC11", "3", "Torino", "Turin", "Piemonte", "Nord-Ovest"), ("037", "ITH55", "3", "Bologna", "Bologna", "Emilia-Romagna", "Nord-Est"),
        ("108", "ITC4D", "3", "Monza", "Monza", "Lombardia", "Nord-Ovest"), ("015", "ITC4C", "3", "Milano", "Milan", "Lombardia", "Nord-Ovest"),
        ("ITC45", "ITC4C", "3", "Milano (old)", "Milan", "Lombardia", "Nord-Ovest"), ("048", "ITI14", "3", "Firenze", "Florence", "Toscana", "Centro"),
        ("04", "ITH1;ITH2", "2", "Trentino-Alto Adige", "Trentino", "Trentino-Alto Adige", "Nord-Est"),
        ("ITCD", "ITC;ITH", "1", "Nord", "North", "", ""), ("dup", "ITF1", "2", "first", "first", "", ""), ("dup", "ITF2", "2", "last", "last", "", ""),
        ("ITF", "", "1", "Sud", "South", "", "Sud"), ("", "ITZ", "1", "Extra", "Extra", "", ""),
    ]
    return table([(*r, i) for i, r in enumerate(lines)], """istat_code string, nuts_code string, nuts_level string,
        nuts_name_it string, nuts_name_en string, region_name string, macro_area string, ord bigint""")
