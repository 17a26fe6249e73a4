"""Parsers from text lines (column ``value``) to typed rows.

Each parser keeps malformed lines instead of failing the job: a line whose
field count or field types do not fit gets ``_corrupt = true`` and NULL
fields; ``valid_rows`` / ``corrupt_rows`` split the two routes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _parse(lines: DataFrame, sep: str, spec: list[tuple[int, str, str]], n_min: int, value_col: str = "value") -> DataFrame:
    """Typed fields of a line, ``_corrupt`` and ``_line``. A line is split once and a field read once: the record
    comes out of a generator, through which no filter on a field is pushed and repeats the parsing."""
    def typed(parts: Column) -> Column:
        raw = {name: F.get(parts, i) for i, name, _ in spec}
        read = [(raw[name] if typ == "string" else F.trim(raw[name]).try_cast(typ)).alias(name) for _, name, typ in spec]
        return F.struct(*read, (F.size(parts) < n_min).alias("_short"))

    def checked(rec: Column) -> Column:
        bad = rec["_short"]
        for _, name, _ in spec:
            bad = bad | rec[name].isNull()
        return F.struct(*[rec[name].alias(name) for _, name, _ in spec], F.coalesce(bad, F.lit(True)).alias("_corrupt"))

    keep = [c for c in lines.columns if c != value_col]
    records = F.transform(F.transform(F.array(F.split(F.col(value_col), sep)), typed), checked)
    out = lines.select(*keep, F.col(value_col).alias("_line"), F.explode(records).alias("_r"))
    return out.select(*keep, *[F.col("_r").getField(name).alias(name) for _, name, _ in spec], F.col("_r._corrupt").alias("_corrupt"), "_line")


def parse_sensor(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``id,timestamp(s),temperature`` → id, timestamp, temperature."""
    return _parse(lines, ",", [(0, "id", "string"), (1, "timestamp", "bigint"),
                               (2, "temperature", "double")], 3, value_col)


def parse_behavior(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``user,item,category,behavior,timestamp(s)`` → user behaviour rows."""
    return _parse(lines, ",", [(0, "user_id", "bigint"), (1, "item_id", "bigint"),
                               (2, "category_id", "int"), (3, "behavior", "string"),
                               (4, "timestamp", "bigint")], 5, value_col)


def parse_login(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``user,ip,state,timestamp(s)`` → login events."""
    return _parse(lines, ",", [(0, "user_id", "bigint"), (1, "ip", "string"),
                               (2, "login_state", "string"), (3, "timestamp", "bigint")], 4, value_col)


# Fixed value: access-log time format (day/month/year:hour:minute:second).
ACCESS_LOG_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"


def parse_access_log(lines: DataFrame, value_col: str = "value", tz: str = "UTC") -> DataFrame:
    """Space-separated access log: 0 ip, 1 user, 3 time, 5 method, 6 url.

    The offset token (field 4) is ignored; the time is read in ``tz``.
    ``timestamp`` is epoch ms.
    """
    parts = F.split(F.col(value_col), " ")
    local = F.try_to_timestamp(F.get(parts, 3), F.lit(ACCESS_LOG_TIME_FORMAT))
    ts = F.to_utc_timestamp(local, tz) if tz.upper() != "UTC" else local
    ms = F.unix_millis(ts)
    out = [
        F.get(parts, 0).alias("ip"),
        F.get(parts, 1).alias("user_id"),
        ms.alias("timestamp"),
        F.get(parts, 5).alias("method"),
        F.get(parts, 6).alias("url"),
    ]
    bad = (F.size(parts) < 7) | ms.isNull()
    keep = [c for c in lines.columns if c != value_col]
    return lines.select(*keep, *out, bad.alias("_corrupt"), F.col(value_col).alias("_line"))


def valid_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("_corrupt")).drop("_corrupt", "_line")


def corrupt_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("_corrupt")).select("_line")
