"""Small frames for tests."""

from pyspark.sql import functions as F

from tidemart import schemas


def frame(spark, schema, rows):
    """Rows given as dicts; what is missing is null."""
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)


def page(mid="m", ts=0, last=None, seq=None, is_new="0", page_id="home", during=None, item=None,
         item_type=None, displays=None, **common):
    return {"common": {"mid": mid, "is_new": is_new, **common},
            "page": {"last_page_id": last, "page_id": page_id, "during_time": during,
                     "item": item, "item_type": item_type},
            "displays": displays, "ts": ts, "seq": ts if seq is None else seq}


def pages(spark, rows):
    schema = schemas.struct(**{f.name: f.dataType for f in schemas.LOG.fields if f.name != "start"})
    rows = [{**r, "common": {f: r["common"].get(f) for f in schema["common"].dataType.names}}
            for r in rows]
    return frame(spark, schema.add("seq", "long"), rows)


def values(df, *columns):
    """Sorted tuples of the columns."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def at(text):
    return F.lit(text).cast("timestamp")
