"""Records that arrive as a stream against a static target table. The caps of dense keys are those of the static side."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kindred.operators.blocking import key_pairs, keys, pool


def stream_key_pairs(stream: DataFrame, targets: DataFrame) -> DataFrame:
    """(s1_id, target_id, pass) of a stream of records: a stateless stream-static equi-join on all passes' keys. A batch frame gives the pairs of key_pairs, once a pass."""
    if not stream.isStreaming:
        pairs = key_pairs(stream, targets)
        return pairs.selectExpr("s1_id", "target_id", "explode(passes) as pass")
    probe = stream.transform(lambda s: keys_of_stream(s))
    return probe.join(pool(targets).withColumnRenamed("id", "target_id"), ["pass", "key"]).select("s1_id", "target_id", "pass")


def keys_of_stream(stream: DataFrame) -> DataFrame:
    """keys() without the distinct, which a stateless query can't have; the keys of one record are distinct as they are."""
    return keys(stream, "probe", distinct=False).withColumnRenamed("id", "s1_id")
