"""What a filter condition says about single columns, as far as Spark's own source filters can say it.

A clause is a tuple: ("and" | "or", clauses), ("not", clause), (operator, column, value) with the operators
eq lt le gt ge, ("in", column, values), ("null" | "notnull", column), or None for what is not understood.
"""

from __future__ import annotations

import datetime as dt
import logging
from typing import Any

from pyspark.sql import Column, SparkSession
from pyspark.sql import types as T

log = logging.getLogger(__name__)

#: A condition that no row can meet.
NEVER = ("never",)
_COMPARISONS = {"EqualTo": "eq", "LessThan": "lt", "LessThanOrEqual": "le", "GreaterThan": "gt", "GreaterThanOrEqual": "ge"}


def _value(v: Any) -> Any:
    if not hasattr(v, "getClass"):
        return v
    kind, text = v.getClass().getName(), v.toString()
    if kind == "java.sql.Date" or kind == "java.time.LocalDate":
        return dt.date.fromisoformat(text)
    if kind == "java.time.LocalDateTime":
        return dt.datetime.fromisoformat(text)
    if kind == "java.sql.Timestamp":  # an instant; its text is in the JVM's zone
        return dt.datetime(1970, 1, 1) + dt.timedelta(seconds=v.getTime() // 1000, microseconds=v.getNanos() // 1000)
    if kind == "java.time.Instant":
        return dt.datetime.fromisoformat(text.replace("Z", "+00:00")).replace(tzinfo=None)
    raise TypeError(kind)


def _clause(f: Any) -> tuple | None:
    kind = f.getClass().getSimpleName()
    if kind in ("And", "Or"):
        return (kind.lower(), [_clause(f.left()), _clause(f.right())])
    if kind == "Not":
        return ("not", _clause(f.child()))
    try:
        column = f.attribute()
        if kind in _COMPARISONS:
            return (_COMPARISONS[kind], column, _value(f.value()))
        if kind == "In":
            return ("in", column, [_value(v) for v in f.values()])
        if kind in ("IsNull", "IsNotNull"):
            return ("null" if kind == "IsNull" else "notnull", column)
        if kind == "StringStartsWith":
            return ("starts", column, f.value())
    except Exception:
        return None
    return None


def clauses(spark: SparkSession, schema: T.StructType, where: Column | str) -> list[tuple | None] | tuple:
    """The conjuncts of a condition, or NEVER. On any doubt the list is shorter, so less is pruned."""
    frame = spark.createDataFrame(spark.sparkContext.emptyRDD(), schema).where(where)  # raises on a bad condition
    try:
        plan = frame._jdf.queryExecution().optimizedPlan()
        strategy = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.datasources, "DataSourceStrategy$"), "MODULE$")
        out: list[tuple | None] = []
        while True:
            name = plan.nodeName()
            if name == "LocalRelation":
                return NEVER
            if name == "Filter":
                todo = [plan.condition()]
                while todo:
                    e = todo.pop()
                    if e.getClass().getSimpleName() == "And":
                        todo += [e.left(), e.right()]
                        continue
                    found = strategy.translateFilter(e, True)
                    if found.isDefined():
                        out.append(_clause(found.get()))
            if not plan.children().size():
                return out
            plan = plan.children().head()
    except Exception as e:  # internal to Spark: without it nothing is pruned, rows are filtered all the same
        log.warning("no file pruning for this condition: %s", e)
        return []


def columns_in(clause: tuple | None) -> set[str]:
    if clause is None or clause == NEVER:
        return set()
    if clause[0] in ("and", "or"):
        return set().union(*(columns_in(c) for c in clause[1]))
    return columns_in(clause[1]) if clause[0] == "not" else {clause[1]}
