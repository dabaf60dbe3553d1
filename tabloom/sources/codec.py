"""Tables of request bodies to feature maps, and predictions back to response bodies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted content types.
JSON, CSV, ANY = "application/json", "text/csv", "*/*"

ANYTHING = "map<string,variant>"
# Java patterns that scan a text once, without nesting.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
NUMERIC_VARIANT = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL\([0-9,]+\)|VOID)$"
# Cells that stand for a missing number.
NO_VALUE = ("", "NaN", "nan", "NA", "N/A", "null", "NULL", "None")
CELL_END, LINE_END = "\u001f", "\u001e"


def _finite(value: Column) -> Column:
    return value.isNotNull() & (F.abs(value) < float("inf"))


def _number(value: Column) -> Column:
    return F.try_variant_get(value, "$", "double")


def _json_rows(body: Column) -> Column:
    """(rows, reason) of a body parsed once: its "features", else its "instances", else the body itself, as maps of numbers.

    A value is a JSON number or null; strings and booleans are no numbers, and neither is one beyond the range of doubles.
    """
    def rows(top: Column) -> Column:
        one, many = F.element_at(top, "features"), F.element_at(top, "instances")
        given = (
            F.when(one.isNotNull(), F.array(F.try_variant_get(one, "$", ANYTHING)))
            .when(many.isNotNull(), F.try_variant_get(many, "$", f"array<{ANYTHING}>"))
            .otherwise(F.array(top))
        )
        return _bound(given, checked)

    def checked(maps: Column) -> Column:
        def wrong(v: Column) -> Column:
            kind = F.schema_of_variant(v)
            return ~kind.rlike(NUMERIC_VARIANT) | ((kind != "VOID") & ~_finite(_number(v)))

        bad = maps.isNull() | F.exists(maps, lambda m: m.isNull() | F.exists(F.map_values(m), wrong))
        values = F.transform(maps, lambda m: F.transform_values(m, lambda _, v: _number(v)))
        return _result(F.when(~bad, values), F.when(bad, F.lit("features are no map of numbers")))

    top = F.try_variant_get(F.try_parse_json(body), "$", ANYTHING)
    return _bound(top, lambda t: F.when(t.isNull(), _result(F.lit(None), F.lit("body is no JSON object"))).otherwise(rows(t)))


def _result(rows: Column, reason: Column) -> Column:
    return F.struct(rows.cast("array<map<string,double>>").alias("rows"), reason.cast("string").alias("reason"))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value worked out once a row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _csv_rows(body: Column) -> Column:
    """(rows, reason) of a header and data lines, in one pass over the body.

    Split at quotes, every second part is quoted: commas and line ends separate in the other parts only, and an empty part between
    two quoted ones is a doubled quote, which stands for one.
    """
    def separated(parts: Column) -> Column:
        last = F.size(parts) - 1

        def outside(p: Column, i: Column) -> Column:
            return (i % 2 == 0) & ~((p == "") & (i > 0) & (i < last))

        def part(p: Column, i: Column) -> Column:
            plain = F.translate(p, ",\n\r", CELL_END + LINE_END)
            return F.when(i % 2 == 1, p).when(outside(p, i), plain).otherwise('"')

        def stray(p: Column, i: Column) -> Column:
            before = F.ltrim(F.reverse(p))
            after = F.ltrim(p)
            opens = (i == last) | (before == "") | F.substring(before, 1, 1).isin(",", "\n")
            closes = (i == 0) | (after == "") | F.substring(after, 1, 1).isin(",", "\n", "\r")
            return outside(p, i) & ~(opens & closes)

        text = F.array_join(F.transform(parts, part), "")
        ill = (
            F.when(body.contains(CELL_END) | body.contains(LINE_END), F.lit("a control character"))
            .when(F.size(parts) % 2 == 0, F.lit("a quote is not closed"))
            .when(F.exists(F.transform(parts, stray), lambda x: x), F.lit("a quote inside a cell"))
        )
        return F.when(ill.isNotNull(), _result(F.lit(None), ill)).otherwise(_bound(F.split(text, LINE_END), lines))

    def lines(all_lines: Column) -> Column:
        filled = F.filter(all_lines, lambda line: F.trim(line) != "")
        return _bound(F.transform(filled, lambda line: F.transform(F.split(line, CELL_END), lambda c: F.trim(c))), table)

    def table(cells: Column) -> Column:
        header, data = F.get(cells, F.lit(0)), F.slice(cells, 2, F.greatest(F.size(cells) - 1, F.lit(0)))

        def wrong(c: Column) -> Column:
            return ~c.isin(*NO_VALUE) & ~(c.rlike(NUMBER) & _finite(c.try_cast("double")))

        reason = (
            F.when(F.size(cells) < 2, F.lit("no data lines"))
            .when(F.size(F.array_distinct(header)) < F.size(header), F.lit("a column name is repeated"))
            .when(F.exists(data, lambda row: F.size(row) != F.size(header)), F.lit("a line has another number of cells than the header"))
            .when(F.exists(data, lambda row: F.exists(row, wrong)), F.lit("a cell is no number"))
        )
        good = F.transform(
            data, lambda row: F.map_from_arrays(header, F.transform(row, lambda c: F.when(~c.isin(*NO_VALUE), c.try_cast("double"))))
        )
        return _bound(reason, lambda r: _result(F.when(r.isNull(), good), r))

    return F.when(body.isNull(), _result(F.lit(None), F.lit("no data lines"))).otherwise(_bound(F.split(body, '"'), separated))


def decode_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`(req_id, content_type, body)` to (`(req_id, pos, features)`, rejects with a `reason`).

    A body that is not wholly readable is rejected: nothing malformed aborts the job or passes as a missing value. NaN and empty
    cells are missing, and so null. A body is parsed once in each of the two results.
    """
    kind, body = F.col("content_type"), F.col("body")
    other = F.concat(F.lit("content type not served: "), F.coalesce(kind, F.lit("none")))
    read = F.when(kind == JSON, _json_rows(body)).when(kind == CSV, _csv_rows(body)).otherwise(_result(F.lit(None), other))
    # generated rows keep the two fields from being worked out apart
    parsed = requests.select("req_id", "content_type", "body", F.explode(F.array(read)).alias("read"))
    good = parsed.select("req_id", F.posexplode("read.rows").alias("pos", "features"))
    rejects = parsed.where("read.reason IS NOT NULL").select("req_id", "content_type", "body", F.col("read.reason").alias("reason"))
    return good, rejects


def encode_responses(predictions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`(req_id, pos, accept, prediction)` to (`(req_id, content_type, body)`, rejects).

    A request's predictions become one body, which the caller's request already bounds.
    """
    as_json = F.col("accept").isin(JSON, ANY)
    as_csv = F.col("accept") == CSV
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "prediction"))), lambda s: s["prediction"])
    grouped = predictions.where(as_json | as_csv).groupBy("req_id", "accept").agg(ordered.alias("values"))
    body = F.when(as_json, F.to_json(F.struct(F.col("values").alias("predictions")))).otherwise(
        F.array_join(F.transform("values", lambda v: v.cast("string")), "\n")
    )
    good = grouped.select("req_id", F.when(as_json, F.lit(JSON)).otherwise(F.lit(CSV)).alias("content_type"), body.alias("body"))
    rejects = (
        predictions.where(~F.coalesce(as_json | as_csv, F.lit(False)))
        .select("req_id", F.concat(F.lit("accept type not served: "), F.coalesce("accept", F.lit("none"))).alias("reason"))
        .distinct()
    )
    return good, rejects
