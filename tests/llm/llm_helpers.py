"""Small tables of documents."""

from __future__ import annotations

import re

DOCS = "doc_id bigint, text string, row struct<x:int>, value string, n string"


def documents(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, (1,), "v", "n") for i, t in rows], DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
