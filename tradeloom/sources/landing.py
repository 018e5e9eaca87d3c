"""The landing feed: a folder of JSON documents, read as a stream.

A document is ``{"key": ..., "value": {<entity>: [...]}}``; one without the envelope, with the arrays
at the top, is accepted as well.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from tradeloom.schemas import LANDING_ENTITIES, document_ddl
from tradeloom.sources.admission import EVERYTHING, Admission

_CORRUPT = "_corrupt_record"
_MARK = "end of documents"


def with_ingest_metadata(df: DataFrame) -> DataFrame:
    """Add the processing time, its day, the source file and the time it was last written."""
    return df.withColumns({"_ingested_at": F.current_timestamp(),
                           "_ingest_date": F.to_date(F.current_timestamp()),
                           "_source_file": F.col("_metadata.file_path"),
                           "_file_time": F.col("_metadata.file_modification_time")})


def unwrap(documents: DataFrame, entities: tuple[str, ...]) -> DataFrame:
    """Bring documents without the envelope into ``value``."""
    flat = F.when(reduce(or_, (F.col(e).isNotNull() for e in entities)),
                  F.struct(*(F.col(e) for e in entities)))
    return documents.withColumn("value", F.coalesce("value", flat)).drop(*entities)


def _unknown(name: Column, known: list[str]) -> Column:
    return ~name.isin(known)


def _without(known: list[str]) -> Callable[[Column], Column]:
    return lambda row: F.map_filter(row, lambda k, _: _unknown(k, known))


def _member(name: Column, text: Column) -> Column:
    """A JSON object's member as text; a map could not hold a name twice."""
    whole = F.to_json(F.create_map(name, text))
    return F.substring(whole, F.lit(2), F.length(whole) - 2)


def _members(fields: str, known: list[str], prefix: str = "") -> Column:
    unknown = F.filter(F.map_entries(fields), lambda e: _unknown(e["key"], known))
    return F.transform(unknown, lambda e: _member(F.concat(F.lit(prefix), e["key"]), e["value"]))


def with_rescued_data(texts: DataFrame, text: str, corrupt: Column,
                      entities: tuple[str, ...] = tuple(LANDING_ENTITIES)) -> DataFrame:
    """Add ``_rescued_data``: what the schema does not name, as a JSON object of path to JSON text.

    Covers unknown fields of the document, of the payload and of the given entities' rows; a document that
    is not JSON is kept whole. NULL when nothing is unknown. A name that a document repeats is repeated
    in the result. The document is taken apart one level per step, so each piece of text is parsed once.
    """
    names, maps = list(LANDING_ENTITIES), "map<string,string>"
    empty = F.create_map().cast(maps)

    def part(holder: str, name: str) -> Column:
        return F.try_element_at(F.col(holder), F.lit(name))

    df = texts.withColumn("_top", F.coalesce(F.from_json(text, maps), empty))
    df = df.withColumn("_payload", F.coalesce(F.from_json(part("_top", "value"), maps), empty))

    found = [_members("_top", ["key", "value", *names]), _members("_payload", names, "value.")]
    for entity in entities:
        fields = LANDING_ENTITIES[entity]
        rows = F.from_json(F.coalesce(part("_payload", entity), part("_top", entity)),
                           f"array<{maps}>")
        extra = F.transform(rows, _without(list(fields)))
        column = f"_extra_{entity}"
        df = df.withColumn(column, F.filter(extra, lambda m: F.size(m) > 0))
        path = F.when(part("_payload", entity).isNotNull(), f"value.{entity}").otherwise(entity)
        found.append(F.when(F.size(column) > 0, F.array(_member(path, F.to_json(column))))
                     .otherwise(F.array().cast("array<string>")))
    df = df.withColumn("_found", F.concat(*found))
    whole = F.when(corrupt.isNotNull(), F.to_json(F.create_map(F.lit(_CORRUPT), corrupt)))
    some = F.when(F.size("_found") > 0, F.concat(F.lit("{"), F.array_join("_found", ","), F.lit("}")))
    rescued = F.coalesce(whole, some)
    return df.withColumn("_rescued_data", rescued).drop(
        "_top", "_payload", "_found", *(f"_extra_{e}" for e in entities))


def parse_documents(texts: DataFrame, entities: tuple[str, ...] = tuple(LANDING_ENTITIES)) -> DataFrame:
    """Documents held as text in ``value``, as `split_documents` gives them, with their rescued data.

    Only the given entities are parsed; the others are known, so they are no rescued data either.
    """
    parsed = F.from_json("value", _document_type(entities), {"columnNameOfCorruptRecord": _CORRUPT})
    if "_known" in texts.columns:
        parsed = F.coalesce("_known", parsed)
    rows = with_rescued_data(texts.withColumn("_doc", parsed), "value",
                             F.coalesce(F.col(f"_doc.{_CORRUPT}"), F.col("_unfit")), entities)
    kept = [c for c in texts.columns if c not in ("value", "_unfit", "_known")]
    documents = rows.select("_doc.*", *kept, "_rescued_data").drop(_CORRUPT)
    return unwrap(documents, entities)


def _document_type(entities: tuple[str, ...]) -> StructType:
    return StructType.fromDDL(document_ddl(*entities) + f", {_CORRUPT} STRING")


def _joined(text: Column) -> Column:
    """Documents in a row with commas between them. A line end between braces cannot be inside a JSON string."""
    return F.when(text.contains("\n") | text.contains("\r"), F.regexp_replace(text, r"\}\s*[\r\n]\s*\{", "},{")).otherwise(text)


def _members_read(value: Column, kind: DataType) -> Column:
    """How many members of JSON objects a parsed value was made from: its fields that are not NULL, at all levels."""
    if isinstance(kind, ArrayType):
        if not isinstance(kind.elementType, StructType):
            return F.lit(0)
        return F.coalesce(F.aggregate(value, F.lit(0), lambda n, x: n + _members_read(x, kind.elementType)), F.lit(0))
    if not isinstance(kind, StructType):
        return F.lit(0)
    return reduce(lambda a, b: a + b, (F.when(value[f.name].isNotNull(), F.lit(1) + _members_read(value[f.name], f.dataType))
                                       .otherwise(F.lit(0)) for f in kind.fields if f.name != _CORRUPT))


def _with_known(texts: DataFrame, entities: tuple[str, ...]) -> DataFrame:
    """Add ``_known``: the parsed documents of a text in which every member is one that the schema names, else NULL.

    Such a text needs no second look for rescued data. It is parsed once, as an array that ends in a mark, and has as many
    names as there are fields that are not NULL. All names are followed by a colon at once and stand in double quotes, or
    the text does not count as known (a colon after a space or a single quote); what only looks like a name inside a string makes one name too many.
    """
    document = _document_type(entities)
    whole = StructType([StructField("documents", ArrayType(document)), StructField(_CORRUPT, StringType())])
    df = texts.withColumn("_joined", _joined(F.col("value")))
    df = df.withColumn("_all", F.from_json(F.concat(F.lit('{"documents":['), "_joined", F.lit(f',{{"key":"{_MARK}"}}]}}')),
                                           whole, {"columnNameOfCorruptRecord": _CORRUPT}))
    read, named = F.col("_all.documents"), F.octet_length("value") - F.octet_length(F.replace("value", F.lit('":')))
    known = (F.col(f"_all.{_CORRUPT}").isNull() & (F.size(read) > 1) & (F.element_at(read, -1)["key"] == _MARK)
             & ~F.exists(read, lambda d: d.isNull()) & (named == 2 * (_members_read(read, ArrayType(document)) - 1))
             & ~F.col("value").rlike(r":(?<=[\s']:)"))
    return df.withColumn("_known", F.when(known, F.slice(read, F.lit(1), F.size(read) - 1))).drop("_joined", "_all")


def split_documents(texts: DataFrame, entities: tuple[str, ...] = ()) -> DataFrame:
    """One row per document of each text in ``value``: a document, an array of them, or several in a row;
    ``_document`` is its position in the text.

    Documents in a row are separated by line ends or commas. The text is read as the inside of an array that
    ends in a mark: if the mark is not read last, something in the text does not fit, and the text stays
    one row and is repeated in ``_unfit``, for the rescued data to keep. Blank texts leave no row.

    With ``entities``, documents of texts that hold nothing but known members are in ``_known``, parsed, and have no ``value``.
    """
    # One step for each time a text is taken apart, and an outer explode: an inner one would have Spark filter
    # by the size of its array before, for which the text would be taken apart again, many times over.
    df = texts.filter(F.col("value").rlike(r"\S"))
    if entities:
        df = _with_known(df, entities)
        df = df.withColumn("value", F.when(F.col("_known").isNull(), F.col("value")))
    df = df.withColumn("_all", F.from_json(F.concat(F.lit("["), _joined(F.col("value")), F.lit(f',"{_MARK}"]')), "array<string>"))
    df = df.withColumn("_docs", F.when(F.element_at("_all", -1) == _MARK, F.slice("_all", F.lit(1), F.size("_all") - 1)))
    array = (F.size("_docs") == 1) & F.col("_docs")[0].startswith("[")
    df = df.withColumn("_unfit", F.when(F.col("_docs").isNull(), F.col("value")))
    df = df.withColumn("_docs", F.when(array, F.from_json(F.col("_docs")[0], "array<string>"))
                       .otherwise(F.coalesce("_docs", F.array("value"))))
    if not entities:
        others = [c for c in df.columns if c not in ("value", "_all", "_docs")]
        return (df.select(*others, F.posexplode_outer("_docs").alias("_document", "value"))
                .filter("_document IS NOT NULL"))
    kind = _document_type(entities)
    parsed = F.transform("_known", lambda d: F.struct(F.lit(None).cast("string").alias("value"), d.alias("_known")))
    unread = F.transform("_docs", lambda t: F.struct(t.alias("value"), F.lit(None).cast(kind).alias("_known")))
    others = [c for c in df.columns if c not in ("value", "_all", "_docs", "_known")]
    df = df.select(*others, F.posexplode_outer(F.coalesce(parsed, unread)).alias("_document", "_item"))
    return df.filter("_document IS NOT NULL").select(*others, "_document", "_item.*")


def _documents(spark: SparkSession, folder: str, multi_line: bool, admission: Admission,
               entities: tuple[str, ...] = tuple(LANDING_ENTITIES)) -> DataFrame:
    """New files of a folder, or their lines, as one row per document with its rescued data."""
    texts = with_ingest_metadata(admission.on(spark.readStream).text(folder, wholetext=multi_line))
    return parse_documents(split_documents(texts, entities), entities)


def landing_stream(spark: SparkSession, folder: str, rescue: bool = True, multi_line: bool = True,
                   admission: Admission = EVERYTHING) -> DataFrame:
    """New documents of the landing folder with ingest metadata.

    A file may hold a document, an array of documents or several in a row; with ``multi_line=False`` it
    holds one or an array per line, and Spark can split it over tasks. ``rescue`` keeps unknown fields and
    what is not JSON; without it such a text still is a row, of NULLs. An empty array gives no document.
    """
    documents = _documents(spark, folder, multi_line, admission)
    return documents if rescue else documents.withColumn("_rescued_data", F.lit(None).cast("string"))


def backfill_stream(spark: SparkSession, folder: str, multi_line: bool = True,
                    admission: Admission = EVERYTHING) -> DataFrame:
    """New documents of the backfill folder, in every shape that landing takes, with rescued data.

    Only their sales orders are parsed. A text that is no JSON is one row, kept whole in the rescued data.
    """
    return _documents(spark, folder, multi_line, admission, ("sales_orders",))
