"""Registered data-test and SQL-surface queries.

E6 (schema description) is a library function only: its work does not
grow with the data, so it is not registered as a query."""

from __future__ import annotations

from .oracle import models_sql  # noqa: F401
from .plans import quality, read_only
from .registry import register

_COLS = quality.REPORT_COLUMNS


def _nn_sql():
    parts = [f"SELECT '{m}' AS model, '{c}' AS column_name, 'not_null' AS test, "
             f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {m}"
             for m, c in quality.NOT_NULL_TESTS]
    return "\nUNION ALL\n".join(parts)


def _uq_sql():
    parts = [f"SELECT '{m}' AS model, '{c}' AS column_name, 'unique' AS test, "
             f"CAST((SELECT count(*) FROM (SELECT {c} FROM {m} WHERE {c} IS NOT NULL GROUP BY {c} "
             f"HAVING count(*) > 1) d) AS BIGINT) AS failures"
             for m, c in quality.UNIQUE_TESTS]
    return "\nUNION ALL\n".join(parts)


def _av_sql():
    parts = []
    for m, c, values in quality.ACCEPTED_VALUES_TESTS:
        lst = ", ".join(f"'{v}'" for v in values)
        parts.append(f"SELECT '{m}' AS model, '{c}' AS column_name, 'accepted_values' AS test, "
                     f"CAST(count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ({lst})) AS BIGINT) AS failures FROM {m}")
    return "\nUNION ALL\n".join(parts)


_NN_DEPS = tuple(sorted({m for m, _ in quality.NOT_NULL_TESTS}))
_UQ_DEPS = tuple(sorted({m for m, _ in quality.UNIQUE_TESTS}))
_AV_DEPS = tuple(sorted({m for m, _, _ in quality.ACCEPTED_VALUES_TESTS}))

register("test_not_null", _COLS, _nn_sql(), _NN_DEPS)(quality.test_not_null)
register("test_unique", _COLS, _uq_sql(), _UQ_DEPS)(quality.test_unique)
register("test_accepted_values", _COLS, _av_sql(), _AV_DEPS)(quality.test_accepted_values)
register("test_suite_report", _COLS,
         "\nUNION ALL\n".join([_nn_sql(), _uq_sql(), _av_sql()]),
         tuple(sorted(set(_NN_DEPS + _UQ_DEPS + _AV_DEPS))))(quality.test_suite_report)

# E5: a statement through the read-only gate, over models exposed as views.
READ_ONLY_EXAMPLE = ("SELECT category_id, CAST(sum(spend) AS DECIMAL(18,2)) AS spend, "
                     "CAST(sum(txn_count) AS BIGINT) AS txn_count FROM spending_by_category GROUP BY category_id")


def _read_only(lake):
    read_only.register_views(lake, ["spending_by_category"])
    return read_only.read_only_sql(lake.spark, READ_ONLY_EXAMPLE)


register("read_only_sql", ["category_id", "spend", "txn_count"], READ_ONLY_EXAMPLE,
         ("spending_by_category",))(_read_only)
