"""What live jobs did, batch by batch."""

import logging

from pyspark.sql.streaming import StreamingQueryListener

logger = logging.getLogger(__name__)


def batch_counts(progress) -> dict[str, int]:
    """Rows read, rows too late, and rows held in state, of one micro-batch's progress."""
    operators = progress["stateOperators"]
    return {
        "batch_id": progress["batchId"],
        "input_rows": progress["numInputRows"],
        "late_rows": sum(operator["numRowsDroppedByWatermark"] for operator in operators),
        "state_rows": sum(operator["numRowsTotal"] for operator in operators),
    }


class JobLog(StreamingQueryListener):
    """Logs each micro-batch and why a job ended; keeps the counts of the last `most` batches in `batches`."""

    def __init__(self, most: int = 1000):
        self.most, self.batches = most, []

    def onQueryStarted(self, event):
        logger.info("job %s started", event.name or event.id)

    def onQueryProgress(self, event):
        done = event.progress
        counts = {
            "batch_id": done.batchId,
            "input_rows": done.numInputRows,
            "late_rows": sum(operator.numRowsDroppedByWatermark for operator in done.stateOperators),
            "state_rows": sum(operator.numRowsTotal for operator in done.stateOperators),
        }
        self.batches = [*self.batches[1 - self.most :], {"job": done.name or str(done.id), **counts}]
        logger.info("job %s: %s", done.name or done.id, counts)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.exception:
            logger.error("job %s failed: %s", event.id, event.exception)
        else:
            logger.info("job %s ended", event.id)
