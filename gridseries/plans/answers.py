"""Answers as they are sent: one message and one JSON array of records for each request."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridseries.operators.validate import unanswered, validate_requests
from gridseries.plans.batch import extract_answers
from gridseries.sinks.writers import RECORD_OPTIONS, response_message, write_raw
from gridseries.session import spread

# hours of one request whose records are put together in one place
CHUNK_HOURS = 24 * 366


def with_records(answers: DataFrame, digits: int | None = None) -> DataFrame:
    """(req_id, time, record): the JSON text of each answered time, its variables in the order they were asked for.

    Values are rounded to `digits` places, if that is given.
    """
    if digits is not None:
        shorter = F.transform("answers", lambda a: F.struct(a["var"].alias("var"), F.round(a["value"], digits).alias("value")))
        answers = answers.withColumn("answers", shorter)
    stamp = F.date_format("time", RECORD_OPTIONS["timestampNTZFormat"])
    values = F.to_json(F.map_from_entries("answers"), RECORD_OPTIONS)
    # the values' text starts with a brace
    record = F.concat(F.lit('{"time":"'), stamp, F.lit('",'), F.substr(values, F.lit(2)))
    return answers.select("req_id", "time", record.alias("record"))


def answer_chunks(records: DataFrame, chunk_hours: int = CHUNK_HOURS) -> DataFrame:
    """(req_id, chunk, n, records): the records of a bounded stretch of time, in order and divided by commas.

    Times are unique within a request, so a chunk has a bound whatever the length of the request.
    """
    hour = F.floor(F.unix_seconds(F.col("time").cast("timestamp")) / 3600)
    chunked = records.withColumn("chunk", F.floor(hour / chunk_hours))
    parts = spread(chunked, "req_id", "chunk").groupBy("req_id", "chunk").agg(F.array_sort(F.collect_list(F.struct("time", "record"))).alias("rows"))
    text = F.array_join(F.transform("rows", lambda r: r["record"]), ",")
    return parts.select("req_id", "chunk", F.size("rows").cast("long").alias("n"), text.alias("records"))


def envelopes(requests: DataFrame, chunks: DataFrame) -> DataFrame:
    """(req_id, n, answer): `{"message": ..., "Data": ...}` of every request that has records, Data being the array as text.

    `requests` has (req_id, source, lat, lon, vars, start_time, end_time, mode). One answer has to fit one row;
    longer ones are read from their chunks.
    """
    order = F.array_sort(F.collect_list(F.struct("chunk", "records")))
    whole = chunks.groupBy("req_id").agg(F.sum("n").alias("n"), order.alias("chunks"))
    data = F.concat(F.lit("["), F.array_join(F.transform("chunks", lambda c: c["records"]), ","), F.lit("]"))
    message = response_message(*(F.col(c) for c in ("source", "lat", "lon", "vars", "start_time", "end_time", "mode")))
    both = requests.join(whole, "req_id").select("req_id", "n", message.alias("message"), data.alias("Data"))
    return both.select("req_id", "n", F.to_json(F.struct("message", "Data")).alias("answer"))


def answer_requests(requests: DataFrame, obs: DataFrame, catalogue: DataFrame, variables: list[str] | None = None,
                    chunk_hours: int = CHUNK_HOURS, digits: int | None = None) -> DataFrame:
    """The envelopes of all accepted requests; those without any time have none, see `validate.unanswered`."""
    records = with_records(extract_answers(requests, obs, catalogue, variables), digits)
    return envelopes(requests, answer_chunks(records, chunk_hours))


def respond(raw: DataFrame, obs: DataFrame, catalogue: DataFrame, path: str, digits: int | None = None) -> DataFrame:
    """(req_id, status, answer) for every text request, as the service would answer it.

    Status 200 has the envelope; 400 has `{"error": ...}`, for a request that is refused or that nothing is found for.
    The envelopes are written to `path` once and read from there, also to find requests without any.
    """
    accepted, rejected = validate_requests(raw)
    write_raw(answer_requests(accepted, obs, catalogue, digits=digits), path)
    sent = raw.sparkSession.read.parquet(path)
    errors = rejected.unionByName(unanswered(accepted, sent))
    refused = errors.select("req_id", F.lit(400).alias("status"), F.to_json(F.struct("error")).alias("answer"))
    return sent.select("req_id", F.lit(200).alias("status"), "answer").unionByName(refused)
