"""Network-flow feature rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def address_octets(address: Column) -> Column:
    """An IPv4 address as four whole numbers."""
    parts = F.split(address, r"\.")
    return F.array(*[F.get(parts, F.lit(i)).cast("bigint") for i in range(4)])


def _port(flows: DataFrame, side: str) -> Column:
    """The port of the outermost transport layer: TCP where there is one, else UDP.

    Sources that split them give `tcp_*` and `udp_*` columns, others plain ones.
    """
    if f"tcp_{side}_port" in flows.columns:
        return F.coalesce(F.col(f"tcp_{side}_port"), F.col(f"udp_{side}_port"))
    return F.col(f"{side}_port")


def flow_features(flows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Octets, ports, payload bytes (0 without payload) and the constant label 0."""
    return flows.select(
        *keep,
        address_octets(F.col("src_ip")).alias("src_ip"),
        address_octets(F.col("dst_ip")).alias("dst_ip"),
        _port(flows, "src").cast("bigint").alias("src_port"),
        _port(flows, "dst").cast("bigint").alias("dst_port"),
        F.coalesce(F.octet_length("payload"), F.lit(0)).cast("bigint").alias("payload_length"),
        F.lit(0).cast("bigint").alias("label"),
    )


def flow_listing(flows: DataFrame, proxy_ip: str | None = None, reverse_proxy_ip: str | None = None) -> DataFrame:
    """The columns of the traffic listing; the proxies are those of the whole listing."""
    return flows.select(
        "direction",
        "traffic_type",
        "src_ip",
        "dst_ip",
        _port(flows, "src").alias("src_port"),
        _port(flows, "dst").alias("dst_port"),
        F.lit(proxy_ip).cast("string").alias("proxy_ip"),
        F.lit(reverse_proxy_ip).cast("string").alias("reverse_proxy_ip"),
    )


def flow_totals(flows: DataFrame) -> DataFrame:
    """Packets per direction and traffic type, with the total per direction on each row.

    Totals come from the counts per type, a few rows, not from a second pass.
    """
    per_type = flows.groupBy("direction", "traffic_type").agg(F.count(F.lit(1)).alias("packets"))
    totals = per_type.groupBy("direction").agg(F.sum("packets").alias("direction_packets"))
    return per_type.join(totals, "direction")
