"""Column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: white space that separates words: blank, and tab to carriage return
BLANK = r"[ \t-\r]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``, inside inner lambdas too."""
    return F.transform(F.array(value), body)[0]


def whole(text: str | Column = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """Runs of characters other than ``BLANK``, in order, as an array."""
    return F.filter(F.split(text, BLANK + "+"), lambda w: w != "")


def squeezed(text: Column) -> Column:
    """The text without its ``BLANK`` characters."""
    return F.regexp_replace(text, BLANK + "+", "")


def word_count(text: Column) -> Column:
    """Number of words, without building them: each word ends before a blank or at the end."""
    return F.regexp_count(text, F.lit("[^ \\t-\\r]++")).cast("long")


def packed(docs: DataFrame) -> DataFrame:
    """(doc, row): all columns of a row in one struct, safe from other names, and a number of its own once this is written."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.monotonically_increasing_id().alias("row"))


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most ``rows`` documents, unless the session already asks for fewer: texts can be long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def per_text(docs: DataFrame, key: str, text: str, make: Callable[[], Callable[[str], tuple]], fields: str) -> DataFrame:
    """Run a function of one whole text (null: empty) over all rows, in Arrow batches inside tasks.

    ``make`` is called once per task and returns the function; its tuples fill the columns named in ``fields``. The key keeps
    its name and type, other columns are dropped.
    """
    bounded_batches(docs.sparkSession)
    return per_value(docs.select(F.col(key), whole(text).alias("_text")), make, fields)


def per_value(light: DataFrame, make: Callable[[], Callable], fields: str) -> DataFrame:
    """As ``per_text`` on a frame of two columns, key and value; the value is passed on as it is."""
    out = T.StructType([light.schema[0], *T._parse_datatype_string(fields).fields])
    arrow = to_arrow_schema(out)

    def run(batches):
        one = make()
        for b in batches:
            made = [one(x) for x in b.column(1).to_pylist()]
            cols = list(zip(*made)) if made else [[] for _ in range(len(arrow) - 1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(arrow[0].type), *[pa.array(c, arrow[i + 1].type) for i, c in enumerate(cols)]], schema=arrow)

    return light.mapInArrow(run, out)
