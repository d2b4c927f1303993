"""What Spark SQL and the checking engine's SQL spell differently; everything else in a lens is common SQL."""

from __future__ import annotations


class SparkSql:
    """The text that runs on Spark."""

    def days(self, late: str, early: str) -> str:
        return f"datediff({late}, {early})"

    def add_months(self, day: str, n: str) -> str:
        return f"add_months({day}, {n})"

    def months(self, first: str, last: str) -> str:
        """The months from first to last, one row each (in a SELECT list)."""
        return f"explode(sequence({first}, {last}, INTERVAL 1 MONTH))"

    def joined(self, x: str, where: str = "") -> str:
        """Distinct texts in order, comma-separated; null if there are none."""
        kept = f"CASE WHEN {where} THEN {x} END" if where else x
        return f"nullif(array_join(array_sort(collect_set({kept})), ', '), '')"

    def json_text(self, x: str, key: str) -> str:
        return f"get_json_object({x}, '$.{key}')"

    def matches(self, x: str, pattern: str) -> str:
        return f"({x} rlike '{pattern}')"

    def extract(self, x: str, pattern: str, group: int) -> str:
        return f"regexp_extract({x}, '{pattern}', {group})"

    def replace_all(self, x: str, pattern: str, by: str) -> str:
        return f"regexp_replace({x}, '{pattern}', '{by}')"

    def hours(self, late: str, early: str) -> str:
        return f"((unix_micros(CAST({late} AS TIMESTAMP)) - unix_micros(CAST({early} AS TIMESTAMP))) / 3600000000.0D)"

    def each_part(self, x: str, by: str) -> str:
        return f"explode(split({x}, '{by}'))"

    def pairs_json(self, first: str, second: str, order: str) -> str:
        """[{"a":..,"b":..}, ..] in order, as text."""
        return f"to_json(transform(array_sort(collect_list(struct({order} AS o, {first} AS a, {second} AS b))), x -> struct(x.a AS a, x.b AS b)))"

    def month_name(self, x: str) -> str:
        return f"date_format({x}, 'MMM yyyy')"

    def size(self, x: str) -> str:
        return f"size({x})"

    def compact(self, *xs: str) -> str:
        return f"array_join(array_compact(array({', '.join(xs)})), ',')"

    def try_number(self, x: str) -> str:
        return f"try_cast({x} AS DOUBLE)"

    def window_start(self, ts: str, seconds: int) -> str:
        return f"timestamp_seconds(floor(unix_seconds(CAST({ts} AS TIMESTAMP)) / {seconds}) * {seconds})"

    def epoch(self, ts: str) -> str:
        return f"unix_seconds(CAST({ts} AS TIMESTAMP))"

    def sha(self, x: str) -> str:
        return f"sha2({x}, 256)"


class DuckSql(SparkSql):
    """The text that an independent engine runs to check the results."""

    def days(self, late: str, early: str) -> str:
        return f"date_diff('day', CAST({early} AS DATE), CAST({late} AS DATE))"

    def add_months(self, day: str, n: str) -> str:
        return f"CAST({day} + to_months(CAST({n} AS INTEGER)) AS DATE)"

    def months(self, first: str, last: str) -> str:
        return f"CAST(unnest(generate_series({first}, {last}, INTERVAL 1 MONTH)) AS DATE)"

    def joined(self, x: str, where: str = "") -> str:
        return f"string_agg(DISTINCT {x}, ', ' ORDER BY {x})" + (f" FILTER (WHERE {where})" if where else "")

    def json_text(self, x: str, key: str) -> str:
        return f"json_extract_string({x}, '$.{key}')"

    def matches(self, x: str, pattern: str) -> str:
        return f"regexp_matches({x}, '{pattern}')"

    def replace_all(self, x: str, pattern: str, by: str) -> str:
        return f"regexp_replace({x}, '{pattern}', '{by}', 'g')"

    def hours(self, late: str, early: str) -> str:
        return f"((epoch_us(CAST({late} AS TIMESTAMP)) - epoch_us(CAST({early} AS TIMESTAMP))) / 3600000000.0::DOUBLE)"

    def each_part(self, x: str, by: str) -> str:
        return f"unnest(string_split({x}, '{by}'))"

    def pairs_json(self, first: str, second: str, order: str) -> str:
        return f"CAST(to_json(list({{'a': {first}, 'b': {second}}} ORDER BY {order}, {first}, {second})) AS VARCHAR)"

    def month_name(self, x: str) -> str:
        return f"strftime({x}, '%b %Y')"

    def size(self, x: str) -> str:
        return f"len({x})"

    def compact(self, *xs: str) -> str:
        return f"array_to_string(list_filter([{', '.join(xs)}], lambda x: x IS NOT NULL), ',')"

    def window_start(self, ts: str, seconds: int) -> str:
        return f"to_timestamp(floor(epoch({ts}) / {seconds}) * {seconds})"

    def epoch(self, ts: str) -> str:
        return f"CAST(floor(epoch({ts})) AS BIGINT)"

    def sha(self, x: str) -> str:
        return f"sha256({x})"


SPARK, DUCK = SparkSql(), DuckSql()
