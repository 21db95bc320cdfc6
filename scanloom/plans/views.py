"""Analytic views over the given tables, written once in the SQL both engines share.

Coordinates are multiples of small powers of two, so sums do not depend on the
order of addition.  Frames hold about 128 points and the covered ground grows
with the tables, so the density per cell stays level at any scale factor.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

#: name -> SELECT text; {T_US} is the one dialect difference (microseconds of ts).
VIEWS = {
    "points": """
        SELECT frame_id, seq, ring, tag, intensity, rgb, is_ground,
               CASE WHEN is_ground THEN bx0 - 8 + (l_partkey * 13 % 256) / 16.0D0 + (l_suppkey % 16) / 256.0D0
                    ELSE bx0 - 8 + 1.125D0 + (l_partkey % 4) * 4 + (l_quantity % 4) / 64.0D0 END AS x,
               CASE WHEN is_ground THEN gy ELSE by0 + 3.125D0 + (l_suppkey % 2) * 8 + (l_linenumber % 4) / 64.0D0 END AS y,
               CASE WHEN is_ground THEN 0.125D0 * (CAST(FLOOR(gy / 2) AS BIGINT) % 2) + l_quantity / 1024.0D0
                    WHEN l_quantity < 24 THEN l_quantity / 256.0D0
                    WHEN l_quantity > 25 THEN 2.25D0 + l_quantity / 512.0D0 ELSE 1.0D0 END AS z
        FROM (SELECT *, CAST(FLOOR(l_orderkey / 32) AS BIGINT) AS frame_id,
                     l_orderkey % 32 * 8 + l_linenumber AS seq, l_linenumber % 4 AS ring,
                     (l_suppkey % 4) * 16 AS tag, l_partkey % 300 - 20 AS intensity,
                     CAST((l_partkey % 256) * 65536 + (l_suppkey % 256) * 256 + l_linenumber AS INT) AS rgb,
                     l_linestatus = 'O' AS is_ground,
                     (CAST(FLOOR(l_orderkey / 512) AS BIGINT) % 8) * 8.0D0 AS bx0,
                     CAST(FLOOR(l_orderkey / 4096) AS BIGINT) * 8.0D0 AS by0,
                     CAST(FLOOR(l_orderkey / 4096) AS BIGINT) * 8.0D0
                       + ((l_suppkey * 29 + l_linenumber * 17 + l_partkey) % 256) / 16.0D0 + (l_partkey % 16) / 256.0D0 AS gy
              FROM lineitem) p""",
    "poses": """
        SELECT frame_id, frame_id * 0.5D0 AS ts,
               (CAST(FLOOR(frame_id / 16) AS BIGINT) % 8) * 8.0D0 + (frame_id % 16) * 0.5D0 AS tx,
               CAST(FLOOR(frame_id / 128) AS BIGINT) * 8.0D0 + 8 + (frame_id % 3) * 0.0625D0 AS ty, 1.0D0 AS tz,
               0.0D0 AS qx, 0.0D0 AS qy, SIN(((frame_id % 64) / 64.0D0 - 0.5D0) / 2) AS qz,
               COS(((frame_id % 64) / 64.0D0 - 0.5D0) / 2) AS qw,
               CASE WHEN n_orders % 5 = 0 THEN 'clamped' ELSE 'interpolated' END AS support
        FROM (SELECT frame_id, SUM(o_custkey) AS n_orders
              FROM (SELECT CAST(FLOOR(o_orderkey / 32) AS BIGINT) AS frame_id, o_custkey FROM orders) o
              GROUP BY frame_id) f""",
    "local_points": """
        SELECT p.frame_id, seq, ring, rgb, is_ground, x, y, z, support, tx, ty, tz,
               (x - tx) * (1 - 2 * qz * qz) + (y - ty) * 2 * qz * qw AS lx,
               (y - ty) * (1 - 2 * qz * qz) - (x - tx) * 2 * qz * qw AS ly, z - tz AS lz
        FROM points p JOIN poses f ON p.frame_id = f.frame_id""",
    "boxes": """
        SELECT CAST(FLOOR(o_orderkey / 32) AS BIGINT) AS frame_id, o_orderkey AS box_id,
               CAST(FLOOR(o_orderkey / 32) AS BIGINT) * 0.5D0 AS ts,
               (CAST(FLOOR(o_orderkey / 512) AS BIGINT) % 8) * 8.0D0 - 8 + (o_custkey * 7 % 64) / 4.0D0 AS x,
               CAST(FLOOR(o_orderkey / 4096) AS BIGINT) * 8.0D0 + (o_custkey * 11 % 64) / 4.0D0 AS y,
               0.5D0 AS z, 2.0D0 AS l, 1.0D0 AS w, 1.0D0 AS h,
               (o_custkey % 64) / 16.0D0 AS yaw, o_custkey % 10 AS class, (o_custkey * 7 % 100) / 100.0D0 AS score
        FROM orders""",
    "traj": """
        SELECT event_type AS topic, event_id, t_us, event_id / 128.0D0 AS x, FLOOR(value * 16) / 128 AS y,
               (user_id % 16) / 16.0D0 AS z, user_id
        FROM (SELECT *, {T_US} AS t_us FROM events) e""",
    "traj_a": "SELECT t_us, event_id, x, y, z FROM traj WHERE topic = 'view'",
    "traj_b": "SELECT t_us, event_id, x, y, z FROM traj WHERE topic = 'click'",
    "messages": """
        SELECT topic, t_us * 1000 AS ts_ns, event_id, user_id, x, y FROM traj""",
    "diag": """
        SELECT event_id, CONCAT('seq=', CASE WHEN user_id % 7 = 0 THEN 'n/a' ELSE CAST(event_id AS VARCHAR(20)) END, ';stamp_ns=',
               CAST(t_us * 1000 AS VARCHAR(30)), ';reason=', topic, ';accepted=', CAST(user_id % 2 AS VARCHAR(4)),
               ';inference_ms=', CAST(user_id % 50 AS VARCHAR(4))) AS line FROM traj""",
}
COLUMN_DEPS = {name: [o for o in VIEWS if o != name and re.search(rf"\b(?:FROM|JOIN) {o}\b", text)] for name, text in VIEWS.items()}


class Tables:
    """Attribute access to base tables (``t.orders``) and views (``t.points``)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.view(name) if name in VIEWS else self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        text = VIEWS[name].replace("{T_US}", "unix_micros(CAST(ts AS TIMESTAMP))").replace("D0", "D").replace("VARCHAR(20)", "STRING").replace("VARCHAR(30)", "STRING").replace("VARCHAR(4)", "STRING")
        parts = {m: getattr(self, m) for m in set(re.findall(r"\b(?:FROM|JOIN) ([a-z_]+)\b", text))}
        text = re.sub(r"\b(FROM|JOIN) ([a-z_]+)\b", r"\1 {\2}", text)
        return self.spark.sql(text, **parts)

    def sql(self, text: str) -> DataFrame:
        """Spark text over the same names, for views local to one query."""
        names = [n for n in [*VIEWS, "orders", "lineitem", "events", "customer", "supplier", "part", "nation"]
                 if re.search(rf"\b(?:FROM|JOIN) {n}\b", text)]
        text = text.replace("D0", "D")
        for n in names:
            text = re.sub(rf"\b(FROM|JOIN) {n}\b", rf"\1 {{{n}}}", text)
        return self.spark.sql(text, **{n: getattr(self, n) for n in names})


def with_views(sql: str) -> str:
    """Prefix a DuckDB query with the view definitions it needs."""
    need: list[str] = []

    def visit(name):
        for dep in COLUMN_DEPS[name]:
            visit(dep)
        if name not in need:
            need.append(name)

    for name in VIEWS:
        if re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql):
            visit(name)
    ctes = [f"{n} AS ({duck(VIEWS[n])})" for n in need]
    body = sql.strip()
    if re.match(r"WITH\b", body, re.I):
        body = re.sub(r"^WITH\s+(RECURSIVE\s+)?", "", body, flags=re.I)
        return "WITH RECURSIVE " + ", ".join([*ctes, duck(body)])
    return ("WITH " + ", ".join(ctes) + " " if ctes else "") + duck(body)


def duck(text: str) -> str:
    text = text.replace("{T_US}", "epoch_us(ts)")
    return re.sub(r"(?<![\w.])(\d+(?:\.\d+)?)D0\b", r"CAST(\1 AS DOUBLE)", text)
