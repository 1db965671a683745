"""Hand stored messages over to a sink, page by page, so that an interrupted hand-over can go on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.sources.files import path_exists, table_folders
from lakeops.sources.writers import overwrite, send_messages

PAGE = "page"


class Replay:
    """Paged messages in a folder, and the journal of the pages that were sent.

    Pages are sent in their order, each by one job. A page that fails is tried again alone, and stops
    the hand-over if it fails ``attempts`` times; the next call goes on with it. A page counts as sent
    once its line is in the journal, so a sink that keeps half a page, or loses the answer, gets that
    page again: a sink that replaces what it has of a page keeps each message once, others may get it
    twice.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def prepare(self, paged: DataFrame) -> None:
        """Store the messages by page, from ``with_page``; nothing is sent yet."""
        overwrite(paged, f"{self.path}/messages", [PAGE])

    def _numbers(self, folder: str) -> list[int]:
        path = f"{self.path}/{folder}"
        if not path_exists(self.spark, path):
            return []
        names = [name for _, name in table_folders(self.spark, path) if name.startswith(f"{PAGE}=")]
        return sorted(int(name.partition("=")[2]) for name in names)

    def sent(self) -> list[int]:
        return self._numbers("journal")

    def waiting(self) -> list[int]:
        done = set(self.sent())
        return [page for page in self._numbers("messages") if page not in done]

    def send(self, sink: Callable[[DataFrame, int], None], attempts: int = 3) -> int:
        """Send what waits; the number of pages sent."""
        count = 0
        for page in self.waiting():
            # Only the folder of the page is opened.
            rows = self.spark.read.parquet(f"{self.path}/messages/{PAGE}={page}")
            for left in reversed(range(attempts)):
                try:
                    sink(rows, page)
                    break
                except Exception:
                    if not left:
                        raise
            marker = self.spark.range(1).select(F.current_timestamp().alias("sent_at"))
            marker.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/journal/{PAGE}={page}")
            count += 1
        return count


def broker_sink(options: dict[str, str], format: str = "kafka") -> Callable[[DataFrame, int], None]:
    """Pages appended to a topic, or to another batch sink."""
    return lambda rows, page: send_messages(rows.select("key", "value"), options, format)


def folder_sink(path: str, format: str = "parquet") -> Callable[[DataFrame, int], None]:
    """Pages as folders, each replaced when it is sent again."""
    return lambda rows, page: rows.write.format(format).mode("overwrite").save(f"{path}/{PAGE}={page}")
