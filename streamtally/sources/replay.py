"""Chat recovered from replay documents.

A document is one JSON object per file whose `comments` array holds the chat; it may have gigabytes. `read_comments`
cuts files into blocks that many tasks read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ABOUT = "streamer struct<name: string, login: string, id: bigint>, video struct<id: string>"
COMMENT = (
    "_id: string, created_at: timestamp, channel_id: string, content_offset_seconds: bigint, "
    "commenter: struct<display_name: string, _id: string, name: string, created_at: timestamp>, "
    "message: struct<body: string, fragments: array<struct<text: string, emoticon: struct<emoticon_id: string>>>, "
    "user_badges: array<struct<_id: string, version: string>>>"
)
DOCUMENT = f"{ABOUT}, comments array<struct<{COMMENT}>>"
# Fixed: every comment has this key once, and text cannot hold it, as its quotes would be escaped there.
MARK = '"content_offset_seconds"'
PIECES = "file string, block long, place long, lead string, rest string, comments long"


def read_replays(spark: SparkSession, path: str) -> DataFrame:
    """Replay files, one document each."""
    return spark.read.schema(DOCUMENT).option("multiLine", True).json(path)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of text between two marks, in the order of their file. The n-th piece holds the rest of the n-th comment
    and then the lead of the next one. Per comment a row with both, the lead null at the start of a block; per block
    a row (place -1) with what it leaves for the next block, and the number of its comments. A file's first piece is the
    document up to its first comment: a row (place -2) and a lead."""
    decoder = json.JSONDecoder()
    rows: list[tuple] = []
    at, lead, n = None, None, 0

    def batch() -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        columns = list(zip(*rows, strict=True))
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["file", "block", "place", "lead", "rest", "comments"])

    for given in batches:
        for file, block, piece in zip(*(given.column(c).to_pylist() for c in ("file", "block", "value")), strict=True):
            if (file, block) != at:
                if at is not None:
                    rows.append((*at, -1, lead, None, n))
                at, lead, n = (file, block), None, 0
                if block == 0:
                    key = piece.rfind('"comments"')
                    start = piece.find("[", key) + 1 if key >= 0 else 0
                    if not start:
                        raise ValueError(f"{file}: no comments array")
                    rows.append((*at, -2, None, piece[:start], 0))
                    lead = piece[start:]
                    continue
            own = "{" + MARK + piece
            try:
                _, end = decoder.raw_decode(own)
            except json.JSONDecodeError as error:
                raise ValueError(f"{file}: comment {n} of the block at {block} cannot be read") from error
            rows.append((*at, n, lead, own[1:end], 0))
            lead, n = own[end:], n + 1
            if len(rows) >= 5000:
                yield batch()
    if at is not None:
        rows.append((*at, -1, lead, None, n))
        yield batch()


def read_comments(spark: SparkSession, path: str) -> DataFrame:
    """streamer, video, row_number (place in the document), _c (the comment) of every comment of the replay files.

    Files are read in blocks of `spark.sql.files.maxPartitionBytes` wherever their store allows it. A comment that
    crosses two blocks is put together from what the one leaves and the other has. An empty array has no rows.
    """
    pieces = spark.read.option("lineSep", MARK).option("recursiveFileLookup", "true").text(path)
    cut = pieces.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value").mapInArrow(_cut, PIECES)
    # One row a block, and one a file: the document up to its first comment, ahead of the file's first block.
    in_file = Window.partitionBy("file").orderBy("block", "place")
    whole_file = in_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # Without its comments a document is small; streamer and video may stand before or behind them.
    document = F.concat(F.first("rest", ignorenulls=True).over(whole_file), F.last("lead").over(whole_file))
    ends = cut.where("place < 0").select(
        "file", "block", F.col("place").alias("_place"),
        F.coalesce(F.sum("comments").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.lag("lead").over(in_file).alias("_left"), F.from_json(document, ABOUT).alias("_about"),
    ).where("_place = -1").drop("_place")
    lead = F.ltrim(F.coalesce("lead", "_left"))
    text = F.concat(F.regexp_replace(lead, r"^,\s*", ""), "rest")
    return (
        cut.where("place >= 0")
        .join(ends, ["file", "block"])
        .select("_about.streamer", "_about.video", (F.col("_before") + F.col("place")).cast("int").alias("row_number"), F.from_json(text, f"struct<{COMMENT}>").alias("_c"))
    )


def _emotes(fragments: Column) -> Column:
    ids = F.transform(
        F.filter(fragments, lambda f: f["emoticon"].isNotNull()), lambda f: f["emoticon"]["emoticon_id"]
    )
    return F.map_from_entries(
        F.transform(
            F.array_distinct(ids),
            lambda i: F.struct(i.alias("id"), F.size(F.filter(ids, lambda other: other == i)).alias("uses")),
        )
    )


def recover_replay_chat(documents: DataFrame, marker: str) -> DataFrame:
    """Live-chat rows from whole documents; see `recover_comments`."""
    return recover_comments(documents.select("streamer", "video", F.posexplode("comments").alias("row_number", "_c")), marker)


def recover_comments(comments: DataFrame, marker: str) -> DataFrame:
    """Live-chat rows from comments. A row is named by its document - `batch_id` is the marker,
    the channel and the video id - and its place in it, so recovering again with more documents gives
    the same names to the same messages."""
    source = F.concat_ws("/", F.lit(marker), "streamer.login", "video.id")
    opened = comments.select(source.alias("batch_id"), F.col("streamer.login").alias("channel"), "row_number", "_c")
    return opened.select(
        "batch_id",
        "row_number",
        "channel",
        F.col("_c.commenter.display_name").alias("chatter"),
        F.col("_c.commenter._id").alias("chatter_id"),
        F.col("_c.message.body").alias("message_text"),
        F.col("_c.created_at").alias("message_sent_at"),
        F.col("_c.created_at").alias("captured_at"),
        F.coalesce(
            F.map_from_entries(F.col("_c.message.user_badges")), F.map_from_arrays(F.array(), F.array()).cast("map<string,string>")
        ).alias("badges"),
        _emotes(F.col("_c.message.fragments")).alias("emotes"),
        F.col("_c.commenter.created_at").alias("account_created_at"),
    )
