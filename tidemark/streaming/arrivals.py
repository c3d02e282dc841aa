"""Files arriving in a folder, applied as micro-batches in append or merge mode.

Progress is the checkpoint's. The batch number and the id that the checkpoint gives its query are stored in the same
commit as the rows, so a batch that is replayed after a crash changes nothing, and a stream that starts again under a
new checkpoint is not taken for a replay.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.clean import clean
from tidemark.sinks.store import TableStore
from tidemark.spec import INCREMENTAL_MODES, SpecError


def load_arrivals(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    store: TableStore,
    mode: str,
    *,
    name: str,
    checkpoint: str,
    pk: Sequence[str] = (),
    incr: str = "",
    key: dict[str, str] | None = None,
    files_per_batch: int | None = None,
    bytes_per_batch: str | None = None,
    every: str | None = None,
    hook: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Start the stream. ``every`` is a processing-time trigger; without it the stream takes what is there and ends.

    ``files_per_batch`` or ``bytes_per_batch`` bound one micro-batch, and so one commit.
    """
    if mode not in INCREMENTAL_MODES:
        raise SpecError(f"a stream appends or merges, not {mode!r}")
    limits = {"maxFilesPerTrigger": files_per_batch, "maxBytesPerTrigger": bytes_per_batch}
    reader = spark.readStream.schema(schema)
    for option, value in limits.items():
        reader = reader.option(option, value) if value else reader

    facts = {"sync_mode": mode, "src_incr_field": incr, "dst_pk": ",".join(pk)}

    @functools.cache
    def run_id() -> str:
        return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]

    def apply(batch: DataFrame, number: int) -> None:
        rows = clean(batch)
        rows = rows.transform(hook) if hook else rows
        store.load(rows, mode, pk=pk, incr=incr, key=key, facts=facts, stream=(name, number, run_id()))

    writer = reader.parquet(folder).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
