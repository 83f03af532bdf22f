"""Fetch and landing status expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def fetch_status(http_code: Column | str, error: Column | str) -> Column:
    """'success' (below 400: an answer after redirects too), 'not_found' (404), 'http_error_{code}', or 'error: {message}'
    when the fetch raised instead of answering."""
    code, err = _c(http_code), _c(error)
    return (
        F.when(err.isNotNull(), F.concat(F.lit("error: "), err))
        .when(code < 400, F.lit("success"))
        .when(code == 404, F.lit("not_found"))
        .otherwise(F.concat(F.lit("http_error_"), code.cast("string")))
    )


def landing_outcome(fetched: Column | str, archive_ok: Column | str, csv_count: Column | str,
                    success_count: Column | str, fetch_state: Column | str) -> Column:
    """Status of one archive after landing.

    Not fetched -> the fetch status; unreadable archive -> 'bad_archive'; no CSV
    member -> 'no_csv_found'; all written -> 'success'; none written ->
    'write_failed'; some -> 'partial_success'.
    """
    return (
        F.when(~_c(fetched), _c(fetch_state))
        .when(~_c(archive_ok), F.lit("bad_archive"))
        .when(_c(csv_count) == 0, F.lit("no_csv_found"))
        .when(_c(success_count) == _c(csv_count), F.lit("success"))
        .when(_c(success_count) == 0, F.lit("write_failed"))
        .otherwise(F.lit("partial_success"))
    )


def landing_message(status: Column | str, csv_count: Column | str, success_count: Column | str) -> Column:
    """Error text stored with the status (NULL on success). The two messages."""
    s = _c(status)
    return (
        F.when(s == "success", F.lit(None).cast("string"))
        .when(s == "no_csv_found", F.lit("No CSV files found in zip archive"))
        .when(s == "bad_archive", F.lit("Archive could not be read"))
        .when(s.isin("partial_success", "write_failed"),
              F.concat(F.lit("Only "), _c(success_count).cast("string"), F.lit("/"),
                       _c(csv_count).cast("string"), F.lit(" files written successfully")))
        .otherwise(s)
    )
