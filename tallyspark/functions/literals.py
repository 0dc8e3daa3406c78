"""Configuration tables as single literal values.

A taxonomy compiled into ``array(struct(lit, ...), ...)`` is a tree of
hundreds of expression nodes that every optimizer rule walks again and
again.  Encoding the same value as JSON and parsing it with ``from_json``
gives one foldable expression: constant folding turns it into a single
typed literal at plan time, so plans stay small and planning fast.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, functions as F


def json_literal(value, ddl: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), ddl)


def string_map(pairs) -> Column:
    """map<string,string> literal; later keys win, as in a dict."""
    return json_literal(dict(pairs), "map<string,string>")
