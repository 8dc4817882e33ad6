"""Small fact tables."""

from datetime import date, datetime

from pyspark.sql import functions as F

from chronovault import schemas


def day(text):
    return date.fromisoformat(text)


def at(text):
    return datetime.fromisoformat(text)


def facts(spark, rows):
    """Rows of (asset, source, business date, system date, metrics, ingest id[, deleted])."""
    full = []
    for row in rows:
        asset, source, bd, sd, metrics, ingest, *deleted = row
        full.append((
            asset, source, day(bd) if isinstance(bd, str) else bd, at(sd) if isinstance(sd, str) else sd, metrics,
            sorted(metrics) if metrics else [], None, ingest, deleted[0] if deleted else None,
        ))
    return spark.createDataFrame(full, schemas.FACTS)


def rows(df, *columns):
    """Rows as sorted tuples of the named columns."""
    picked = df.select(*columns) if columns else df
    return in_order(tuple(r) for r in picked.collect())


def in_order(tuples):
    return sorted(tuples, key=lambda t: ["" if x is None else str(x) for x in t])


def one(df, expression):
    """The value of an expression on the only row."""
    return df.select(expression.alias("x")).collect()[0]["x"]


def value(spark, expression):
    return one(spark.range(1), expression)


def metric(name):
    return F.try_element_at("metrics", F.lit(name)).alias(name)
