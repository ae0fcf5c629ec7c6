"""Small rows with the columns that matter; the rest is NULL."""

from datetime import date, datetime

from tramline.schemas import conform


def rows(spark, layout, *records):
    """DataFrame of ``layout`` from dicts; date and timestamp texts are parsed."""
    schema = spark.createDataFrame([], layout).schema

    def parse(field, value):
        kind = field.dataType.typeName()
        if isinstance(value, str) and kind == "date":
            return date.fromisoformat(value)
        if isinstance(value, str) and kind == "timestamp_ntz":
            return datetime.fromisoformat(value)
        return value

    data = [tuple(parse(f, r.get(f.name)) for f in schema) for r in records]
    return conform(spark.createDataFrame(data, schema), layout)
