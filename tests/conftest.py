"""One local Spark session for the whole test run, with a private checkpoint folder."""

from __future__ import annotations

import csv
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]")
         .appName("trackframe-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="trackframe-test-ckpt-"))
    yield s
    s.stop()


# The canonical columns of a delivery, and a valid answer sheet.
ANSWERS = {"respondent_id": "", "wave": "", "fieldwork_date": "2031-05-04", "region": "Harbour", "age_group": "35-44",
           "weight": "1", "nps_score": "7", "satisfaction": "3", "aware": "0", "brand_used": "Lantern"}


def deliver(folder, name, *sheets, drop=(), rename=None):
    """Write a delivery of answer sheets (dicts over ``ANSWERS``) as ``folder/name``; returns its path."""
    rename = rename or {}
    columns = [c for c in ANSWERS if c not in drop]
    folder.mkdir(exist_ok=True)
    with open(folder / name, "w", encoding="utf-8", newline="") as fh:
        out = csv.writer(fh)
        out.writerow(rename.get(c, c) for c in columns)
        out.writerows([{**ANSWERS, **sheet}[c] for c in columns] for sheet in sheets)
    return str(folder / name)


def sheets(wave, **scores):
    """Answer sheets of one wave, ``respondent=score``."""
    return [{"respondent_id": k, "wave": str(wave), "nps_score": str(v)} for k, v in scores.items()]
