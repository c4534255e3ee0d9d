"""Retry of a whole batch write: transient faults with growing delays, others at once."""

import time

from pyspark.errors import AnalysisException, IllegalArgumentException, ParseException, PySparkTypeError

PERMANENT = (AnalysisException, ParseException, IllegalArgumentException, PySparkTypeError, TypeError, KeyError)


class RetriesExhausted(RuntimeError):
    pass


def is_transient(error: Exception) -> bool:
    return not isinstance(error, PERMANENT)


def with_retry(action, attempts: int = 5, first_delay: float = 1.0, transient=is_transient, sleep=time.sleep):
    """Run ``action``; after a transient failure wait 1, 2, 4, 8 ... times ``first_delay``.
    When attempts run out the error is raised: the stream stops and its checkpoint stays."""
    for attempt in range(1, attempts + 1):
        try:
            return action()
        except Exception as error:
            if not transient(error):
                raise
            if attempt == attempts:
                raise RetriesExhausted(f"failed after {attempts} attempts: {error}") from error
            sleep(first_delay * 2 ** (attempt - 1))
