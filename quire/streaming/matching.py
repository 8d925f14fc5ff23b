"""Matching of a stream of records with a static bibliography."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions.scoring import Weights
from ..operators.matching import index, match
from ..sources.sinks import in_batches


def read_records(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def match_stream(subjects: DataFrame, items: DataFrame, output: str, checkpoint: str, weights: Weights = Weights(), top_n: int = 5, min_score: float = 0.0, available_now: bool = True) -> StreamingQuery:
    """The best matches of each micro-batch of subjects, appended to output. Batches need no state of each other, as items are static: they are indexed once, before the first."""
    indexed = index(items, "item_index")
    writer = subjects.writeStream.foreachBatch(in_batches(lambda batch: match(batch, None, weights, top_n, min_score, indexed=indexed), output)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def compose(*steps: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """One step of several, each of which takes and gives a frame: the place to put in a scraper, a matcher or a writer."""

    def run(df: DataFrame) -> DataFrame:
        for step in steps:
            df = df.transform(step)
        return df

    return run


class Progress(StreamingQueryListener):
    """Calls `tell` with the rows done so far, each time that `every` more are done."""

    def __init__(self, tell: Callable[[int], None], every: int = 10) -> None:
        self.tell, self.every, self.done, self.told = tell, every, 0, 0

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self.done += event.progress.numInputRows
        if self.done - self.told >= self.every:
            self.told = self.done
            self.tell(self.done)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass
