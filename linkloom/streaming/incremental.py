"""Source-1 records as a stream against fixed candidates.

A record's candidates depend on the candidates' statistics only, so the lists do not depend on how the stream is cut.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from linkloom.config import Options
from linkloom.operators import blocking as B
from linkloom.sources.records import first_rows, normalize


def stream_candidates(source1: DataFrame, candidates: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, options: Options = Options()):
    """Starts a query that hands the candidate lists of each micro-batch to ``sink``.

    candidates: normalized, deduplicated records, not a stream.
    """
    counts = B.gram_counts(candidates)
    keys = B.long_keys(B.with_keys(candidates, counts))

    def one(batch: DataFrame, epoch: int) -> None:
        rows = normalize(first_rows(batch))
        pairs = B.capped_block_join(B.long_keys(B.with_keys(rows, counts)), keys, options.block_cap)
        sink(B.collapse_ids(pairs, rows.selectExpr("entity_id AS source1_entity_id"), "candidate_entity_ids"), epoch)

    return source1.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
