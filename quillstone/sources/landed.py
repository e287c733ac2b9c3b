"""Readers of landed files: each takes a path and returns typed rows.

Malformed lines and numbers never raise; what is dropped is said with each reader.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.functions import dates, ids, numbers
from quillstone.operators.maintain import dedupe_first
from quillstone.operators.select import sanitised
from quillstone.schemas import DOCUMENT_SCHEMAS, TABLES
from quillstone.sources.files import file_system


def file_name() -> Column:
    """The name of the file that a row was read from; Spark gives it as part of an address, with signs encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def with_year_quarter(df: DataFrame, path: Column | None = None) -> DataFrame:
    """`df` with year and quarter from a path <year>/QTR<n>_… or <year>/QTR<n>/…; null for other paths."""
    p = F.col("_metadata.file_path") if path is None else path
    year, quarter = (F.regexp_extract(p, r"/(\d{4})/(QTR[1-4])(?:_[^/]*|/[^/]*)*$", i) for i in (1, 2))
    return df.withColumns({"year": F.nullif(year, F.lit("")).cast("int"), "quarter": F.nullif(quarter, F.lit(""))})


def read_filing_index(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Index lines with five fields, a numeric company number, a file under edgar/data/ and a date; all other lines go. Gzip is read too."""
    lines = with_year_quarter(spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_path")), F.col("_path"))
    f = F.split("value", r"\|", -1)
    part = [F.trim(F.get(f, F.lit(i))) for i in range(5)]
    day = F.coalesce(F.try_to_timestamp(part[3], F.lit("yyyyMMdd")), F.try_to_timestamp(part[3], F.lit("yyyy-MM-dd"))).cast("date")
    rows = lines.where((F.size(f) == 5) & part[0].rlike(r"^\d+$") & part[4].startswith("edgar/data/"))
    return rows.select(
        ids.norm_cik(part[0]).alias("cik"), part[1].alias("company_name"), part[2].alias("form_type"), day.alias("date_filed"), part[4].alias("filename"), ids.accession_of(part[4]).alias("accession"), "year", "quarter"
    ).where("date_filed is not null")


def read_symbol_directory(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Rows of a pipe-delimited directory (nasdaq_listed or other_listed): cells trimmed, short rows padded, header and trailer dropped."""
    schema = TABLES[kind].schema()
    lines = spark.read.text(path).where(~F.col("value").startswith("File Creation") & (F.trim("value") != ""))
    f = F.split("value", r"\|", -1)
    cells = [F.trim(F.get(f, F.lit(i))).try_cast(field.dataType).alias(field.name) for i, field in enumerate(schema)]
    first = F.trim(F.get(f, F.lit(0)))
    return lines.where(~first.isin("Symbol", "ACT Symbol")).select(*cells)


def read_bls_series(spark: SparkSession, path: str) -> DataFrame:
    """A tab-delimited series catalog with padded headers; synonyms by the first that is not blank; rows without an id go."""
    raw = spark.read.csv(path, sep="\t", header=True, inferSchema=False)
    rows = raw.select(*[F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")).alias(c.strip()) for c in raw.columns])

    def pick(*names: str) -> Column:
        return F.coalesce(*[F.col(n) for n in names if n in rows.columns], F.lit(None).cast("string"))

    title = pick("series_title", "series_name", "title")
    seasonal = pick("seasonal", "seasonal_code", "seasonality_code")
    return rows.select(pick("series_id").alias("series_id"), title.alias("title"), pick("area_code", "area").alias("area_code"), pick("item_code", "item").alias("item_code"), seasonal.alias("seasonal"), pick("begin_year").try_cast("int").alias("begin_year"), pick("end_year").try_cast("int").alias("end_year")).where("series_id is not null")


def read_bls_observations(spark: SparkSession, path: str) -> DataFrame:
    """Observations of an API response: (series_id, date, year, period, value, footnotes); blank values are null."""
    schema = "Results struct<series:array<struct<seriesID:string,data:array<struct<year:string,period:string,value:string,footnotes:array<struct<code:string,text:string>>>>>>>"
    rows = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("Results.series").alias("s")).select("s.seriesID", F.explode("s.data").alias("d"))
    notes = F.array_join(F.filter(F.transform("d.footnotes", lambda n: n["text"]), lambda t: F.coalesce(t, F.lit("")) != ""), ", ")
    day = dates.bls_period_date(F.col("d.year"), F.col("d.period"))
    return rows.select(F.col("seriesID").alias("series_id"), day.alias("date"), F.col("d.year").try_cast("int").alias("year"), F.col("d.period").alias("period"), numbers.parse_num(F.col("d.value")).alias("value"), F.coalesce(notes, F.lit("")).alias("footnotes"))


def in_date_order(observations: DataFrame, by: Sequence[str] = ("series_id",)) -> DataFrame:
    """Parsed observations by series and date, for an export; a table needs no order."""
    return observations.orderBy(*by, "date")


def read_sdmx_json(spark: SparkSession, path: str, code: str) -> DataFrame:
    """Observations whose keys are positions in the dimensions' code lists: (code, date, value, dimensions, dimension_key).

    The date is of the first dimension whose code parses as a period; observations without one go.
    """
    dims = "array<struct<id:string,values:array<struct<id:string,name:string>>>>"
    schema = f"structure struct<dimensions:struct<observation:{dims}>>, dataSets array<struct<observations:map<string,array<string>>>>"
    rows = spark.read.schema(schema).json(path, multiLine=True).select(F.col("structure.dimensions.observation").alias("dims"), F.explode("dataSets").alias("d"))
    obs = rows.select("dims", F.explode("d.observations").alias("k", "v"))
    at = F.split("k", ":")
    pairs = F.transform("dims", lambda d, i: F.struct(d["id"].alias("key"), F.get(d["values"], F.get(at, i).try_cast("int"))["id"].alias("value")))
    known = obs.withColumn("pairs", F.filter(pairs, lambda p: p["value"].isNotNull())).withColumn("dates", F.array_compact(F.transform("pairs", lambda p: F.when(dates.sdmx_period_date(p["value"]).isNotNull(), F.struct(p["key"].alias("k"), dates.sdmx_period_date(p["value"]).alias("d"))))))
    first = F.try_element_at("dates", F.lit(1))
    rest = F.map_from_entries(F.filter("pairs", lambda p: p["key"] != first["k"]))
    value = numbers.parse_num(F.get("v", F.lit(0)))
    out = known.select(F.lit(code).alias("code"), first["d"].alias("date"), value.alias("value"), rest.alias("dimensions"))
    return out.where("date is not null").withColumn("dimension_key", ids.dimension_key(F.col("dimensions")))


def read_sdmx_table(df: DataFrame, code: str, time_col: str | None = None, value_col: str | None = None) -> DataFrame:
    """A tabular cube: long frames have a time and a value column, wide ones a column for each period; all others are dimensions."""
    lower = {c.lower(): c for c in reversed(df.columns)}
    time_col = time_col or next((lower[n] for n in ("time_period", "time", "date", "period") if n in lower), None)
    value_col = value_col or next((lower[n] for n in ("obs_value", "value", "values") if n in lower), None)
    if time_col is None or value_col is None:
        periods = [c for c in df.columns if c.strip()[:4].isdigit()]
        if not periods:
            raise ValueError("neither a time column nor columns for periods")
        dims = [c for c in df.columns if c not in periods]
        df = df.select(*dims, *[F.col(f"`{c}`").cast("string").alias(c) for c in periods]).unpivot(dims, periods, "_time", "_value")
        time_col, value_col = "_time", "_value"
    dims = [c for c in df.columns if c not in (time_col, value_col)]
    pairs = [F.struct(F.lit(c).alias("key"), F.col(f"`{c}`").cast("string").alias("value")) for c in dims]
    held = F.map_from_entries(F.filter(F.array(*pairs), lambda p: p["value"].isNotNull())) if pairs else F.create_map().cast("map<string,string>")
    rows = df.select(F.lit(code).alias("code"), dates.sdmx_period_date(F.col(f"`{time_col}`").cast("string")).alias("date"), numbers.parse_num(F.col(f"`{value_col}`").cast("string")).alias("value"), held.alias("dimensions"))
    return rows.where("date is not null").withColumn("dimension_key", ids.dimension_key(F.col("dimensions")))


def read_indicator_table(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """A Parquet or CSV table, between two days by the first column that is named like a date, if there is one."""
    df = spark.read.csv(path, header=True) if path.rstrip("/").lower().endswith(".csv") else spark.read.parquet(path)
    col = next((c for c in df.columns if any(w in c.lower() for w in ("date", "time", "period", "year"))), None)
    if col is None or (start is None and end is None):
        return df
    day = F.coalesce(F.try_to_timestamp(F.col(f"`{col}`").cast("string")).cast("date"), dates.sdmx_period_date(F.col(f"`{col}`").cast("string")))
    keep = F.lit(True)
    if start is not None:
        keep = keep & (day >= F.lit(start).cast("date"))
    if end is not None:
        keep = keep & (day <= F.lit(end).cast("date"))
    return df.where(keep)


def read_series_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Series of catalog pages, the first occurrence of an id; notes fall back to the description, the country comes from the id."""
    s = "struct<id:string,title:string,units:string,frequency:string,seasonal_adjustment:string,observation_start:string,observation_end:string,last_updated:string,popularity:int,notes:string,description:string>"
    pages = spark.read.schema(f"seriess array<{s}>").json(path, multiLine=True).select("seriess", F.col("_metadata.file_path").alias("page"))
    rows = pages.select("page", F.posexplode("seriess").alias("pos", "s")).select("page", "pos", "s.*").where("id is not null")
    first = dedupe_first(rows, ["id"], [F.col("page"), F.col("pos")])
    return first.withColumn("notes", F.coalesce("notes", "description")).withColumn("country", ids.series_country(F.col("id"))).drop("page", "pos", "description").withColumnRenamed("id", "series_id")


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    """(category_id, name, parent_id) of category pages, the parent 0 where none is given."""
    pages = spark.read.schema("categories array<struct<id:long,name:string,parent_id:long>>").json(path, multiLine=True)
    rows = pages.select(F.explode("categories").alias("c")).select(F.col("c.id").alias("category_id"), "c.name", F.coalesce("c.parent_id", F.lit(0)).alias("parent_id"))
    return dedupe_first(rows, ["category_id"], [F.col("parent_id"), F.col("name")])


def read_company_exchange(spark: SparkSession, path: str) -> DataFrame:
    """(cik, ticker, title, exchange) of a dict or a list of records; rows without a number or an exchange go."""
    record = "struct<cik_str:string,ticker:string,title:string,exchange:string>"
    text = spark.read.text(path, wholetext=True)
    listed = F.coalesce(F.from_json("value", f"array<{record}>"), F.array().cast(f"array<{record}>"))
    mapped = F.coalesce(F.map_values(F.from_json("value", f"map<string,{record}>")), F.array().cast(f"array<{record}>"))
    rows = text.select(F.explode(F.when(F.trim("value").startswith("["), listed).otherwise(mapped)).alias("r")).select("r.*")
    return rows.where(F.col("cik_str").isNotNull() & (F.trim(F.coalesce("exchange", F.lit(""))) != "")).select(ids.norm_cik(F.col("cik_str")).alias("cik"), "ticker", "title", "exchange")


def read_html_table(df: DataFrame, html: str = "html", width: int = 3) -> DataFrame:
    """Rows of the tables in a page as arrays of `width` cells, padded with empty ones; pages without tables give their | a | b | lines."""
    row = F.explode(F.concat(F.regexp_extract_all(html, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1)), F.regexp_extract_all(html, F.lit(r"(?m)^\s*(\|.*\|)\s*$"), F.lit(1))))
    rows = df.select(*[c for c in df.columns if c != html], row.alias("_r"))
    tags = F.regexp_extract_all("_r", F.lit(r"(?is)<td[^>]*>(.*?)</td>"), F.lit(1))
    pipes = F.split(F.regexp_replace(F.trim("_r"), r"^\||\|$", ""), r"\|", -1)
    cells = F.transform(F.when(F.col("_r").startswith("|"), pipes).otherwise(tags), lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"\s+", " ")))
    kept = rows.withColumn("cells", cells).where(F.size("cells") > 0)
    return kept.withColumn("cells", F.slice(F.concat("cells", F.array_repeat(F.lit(""), width)), 1, width)).drop("_r")


def parse_listing_table(df: DataFrame, html: str = "html", prefix: str = "/us/products/") -> DataFrame:
    """Funds of a listing page: the first cell of at most five letters or digits is the ticker, the first longer one the name, the first product link the link."""
    row = F.explode(F.regexp_extract_all(html, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1)))
    rows = df.select(*[c for c in df.columns if c != html], row.alias("_r"))
    cells = F.transform(F.regexp_extract_all("_r", F.lit(r"(?is)<td[^>]*>(.*?)</td>"), F.lit(1)), lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"\s+", " ")))
    ticker = F.try_element_at(F.filter("_c", lambda c: c.rlike("^[A-Za-z0-9]{1,5}$")), F.lit(1))
    name = F.try_element_at(F.filter("_c", lambda c: F.length(c) > 5), F.lit(1))
    link = F.nullif(F.regexp_extract("_r", f"href=[\"']({prefix}[^\"']*)[\"']", 1), F.lit(""))
    return rows.withColumn("_c", cells).withColumns({"ticker": ticker, "name": name, "link": link}).drop("_r", "_c").where("ticker is not null")


def read_two_section_csv(spark: SparkSession, path: str) -> DataFrame:
    """(file, section, line_no, cells) of CSV files with a preamble, a header, rows, a second header and rows; headers are cells of line 0 of a section.

    A header is a line that starts with Name or Ticker and names Sector, Weight or Asset Class.
    """
    lines = spark.read.text(path, wholetext=True).select(F.regexp_extract(file_name(), r"^(.*?)(?:\.csv)?$", 1).alias("file"), F.posexplode(F.split("value", r"\r?\n", -1)).alias("line_no", "line"))
    is_header = F.col("line").rlike('^"?(Name|Ticker)"?,') & F.col("line").rlike("Sector|Weight|Asset Class")
    from quillstone.operators.aggregate import running_section

    rows = running_section(lines, is_header, ["file"], "line_no").where((F.col("section") > 0) & (F.trim("line") != ""))
    cells = F.transform(F.regexp_extract_all(F.concat("line", F.lit(",")), F.lit(r'("(?:[^"]|"")*"|[^,]*),'), F.lit(1)), lambda c: F.trim(F.replace(F.regexp_replace(c, r'^"|"$', ""), F.lit('""'), F.lit('"'))))
    return rows.select("file", "section", "line_no", is_header.alias("is_header"), cells.alias("cells"))


def section_records(rows: DataFrame, section: int) -> DataFrame:
    """(file, line_no, record) of one section, the record a map from sanitised header to cell."""
    mine = rows.where(F.col("section") == section)
    heads = mine.where("is_header").select("file", F.col("cells").alias("_h"))
    names = F.transform("_h", lambda h: F.trim(F.regexp_replace(F.lower(F.replace(h, F.lit("%"), F.lit(" pct "))), "[^0-9a-z]+", "_"), F.lit("_")))
    both = mine.where("not is_header").join(heads, "file")
    n = F.least(F.size("_h"), F.size("cells"))
    return both.select("file", "line_no", F.map_from_arrays(F.slice(names, F.lit(1), n), F.slice("cells", F.lit(1), n)).alias("record"))


def read_symbol_documents(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(symbol, document) of one JSON file for each symbol, named by it; unreadable files have a null document and go."""
    text = spark.read.text(path, wholetext=True).select(F.regexp_extract(file_name(), r"^(.*?)(\.json)?$", 1).alias("symbol"), "value")
    return text.select("symbol", F.from_json("value", DOCUMENT_SCHEMAS[kind]).alias("document")).where("document is not null")


def read_ohlcv(spark: SparkSession, path: str, symbol: Column | None = None, source: str = "landed") -> DataFrame:
    """Daily bars of CSV files: the date from Date, date, index or the first column, missing columns null."""
    df = spark.read.csv(path, header=True)
    names = {sanitised(c): c for c in reversed(df.columns)}
    day = next((names[n] for n in ("date", "index") if n in names), df.columns[0])
    stem = F.regexp_extract(file_name(), r"^(.*?)(\.csv)?$", 1)
    out = [(stem if symbol is None else symbol).alias("symbol"), F.substring(F.col(f"`{day}`"), 1, 10).try_cast("date").alias("date")]
    for f in TABLES["ohlcv"].schema()[2:-1]:
        raw = F.col(f"`{names[f.name]}`") if f.name in names else F.lit(None).cast("string")
        out.append(raw.try_cast("double").try_cast(f.dataType).alias(f.name))
    return df.select(*out, F.lit(source).alias("source")).where("date is not null")


def read_paged_csv(spark: SparkSession, path: str) -> DataFrame:
    """Pages of one data set, each with the header."""
    return spark.read.csv(path, header=True)


def read_dataset_catalog(spark: SparkSession, path: str) -> DataFrame:
    """(group, name, description) of a data-set catalog."""
    rows = spark.read.schema("datasets array<struct<group:string,name:string,description:string>>").json(path, multiLine=True)
    return rows.select(F.explode("datasets").alias("d")).select("d.*")


def dataset_groups(catalog: DataFrame) -> DataFrame:
    return catalog.select("group").where("group is not null").distinct().orderBy(F.lower("group"))


def read_candles(spark: SparkSession, path: str) -> DataFrame:
    """Candle snapshots, with the start as a timestamp."""
    text = spark.read.text(path, wholetext=True)
    # names differ by case only (t and T), so the records are read as maps
    records = text.select(F.explode(F.from_json("value", "array<map<string,string>>")).alias("m"))
    get = lambda k: F.try_element_at("m", F.lit(k))
    numbers_ = [get(k).try_cast("double").alias(k) for k in ("o", "c", "h", "l", "v")]
    return records.select(get("t").try_cast("long").alias("t"), get("T").try_cast("long").alias("T_end"), get("s").alias("s"), get("i").alias("i"), *numbers_, get("n").try_cast("long").alias("n"), F.timestamp_millis(get("t").try_cast("long")).alias("start"))


def read_coins(spark: SparkSession, path: str) -> DataFrame:
    """(coin, ord): the coin universe of metadata documents, in its order; entries without a name go."""
    meta = spark.read.schema("universe array<struct<name:string>>").json(path, multiLine=True)
    return meta.select(F.posexplode("universe").alias("ord", "u")).select(F.col("u.name").alias("coin"), "ord").where("coin is not null")


def read_trades(spark: SparkSession, path: str) -> DataFrame:
    """Trades, with their time as a timestamp."""
    rows = spark.read.schema("coin string, side string, px string, sz string, time long, tid long").json(path)
    return rows.select("coin", "side", F.col("px").try_cast("double").alias("px"), F.col("sz").try_cast("double").alias("sz"), F.timestamp_millis("time").alias("time"), "tid")


def read_filings(spark: SparkSession, root: str, year: int, quarter: str, form: str) -> DataFrame:
    """(accession, content) of the loose texts of one year, quarter and form; only that folder is read."""
    text = spark.read.option("pathGlobFilter", "*.txt").text(f"{root}/{year}/{quarter}/{form.replace('/', '_')}", wholetext=True)
    return text.select(F.regexp_extract(file_name(), r"^(.*)\.txt$", 1).alias("accession"), F.col("value").alias("content"))


def read_filings_zip(spark: SparkSession, path: str | Sequence[str], members_at_once: int = 500) -> DataFrame:
    """(archive, accession, content) of the text members of archives; folders of other systems and other members go.

    Archives are opened by their path, through the file system that Spark reads with, and never
    held whole: the lists of members come first, and ranges of `members_at_once` members are dealt
    to tasks, each of which reads its members only. An archive may so be larger than a row can be.
    """
    folder = spark.read.format("binaryFile").load(path).select(F.col("path").alias("archive"))

    def opened(name: str):
        import zipfile

        system, inner = file_system(name)
        return zipfile.ZipFile(system.open_input_file(inner))

    def listed(batches):
        import pandas as pd

        for b in batches:
            for name in b["archive"]:
                with opened(name) as z:
                    texts = sum(m.filename.endswith(".txt") and not m.filename.startswith("__MACOSX/") for m in z.infolist())
                yield pd.DataFrame({"archive": name, "begin": range(0, texts, members_at_once)})

    def members(batches):
        import pandas as pd

        for b in batches:
            for name, begin in zip(b["archive"], b["begin"], strict=True):
                with opened(name) as z:
                    texts = [m for m in z.infolist() if m.filename.endswith(".txt") and not m.filename.startswith("__MACOSX/")]
                    for m in texts[begin : begin + members_at_once]:
                        yield pd.DataFrame({"archive": [name], "accession": [m.filename.rsplit("/", 1)[-1][:-4]], "content": [z.read(m).decode("utf-8", "ignore")]})

    ranges = folder.mapInPandas(listed, "archive string, begin long").repartition(spark.sparkContext.defaultParallelism, "archive", "begin")
    return ranges.mapInPandas(members, "archive string, accession string, content string")


#: Bytes of files that are handed on together.
BYTES_AT_ONCE = 4 << 20


def read_whole_files(spark: SparkSession, path: str) -> DataFrame:
    """(name, value): files as bytes, of a file, a folder, or all files and folders that a pattern names.

    The driver sees only what the pattern names. Folders are listed and files opened by tasks, so
    that millions of files need no memory of the driver; a folder's list is held by its task. As
    with Spark's readers hidden files go, and folders in a folder are not entered.
    """
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path)
    named = [(s.getPath().toString(), s.isDirectory()) for s in pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or ()]
    named = [(a, folder) for a, folder in named if not a.rsplit("/", 1)[-1].startswith(("_", "."))]
    if not named:
        raise FileNotFoundError(path)

    def listed(batches):
        import pyarrow as pa
        from pyarrow import fs

        for b in batches:
            for address, folder in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found = [address]
                if folder:
                    system, inner = file_system(address)
                    infos = system.get_file_info(fs.FileSelector(inner))
                    found = [f"{address}/{i.base_name}" for i in infos if i.type == fs.FileType.File and not i.base_name.startswith(("_", "."))]
                for k in range(0, len(found), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(found[k : k + 10_000], pa.string())], names=["address"])

    def opened(batches):
        import pyarrow as pa

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.binary())], names=["name", "value"])

        names, values, size = [], [], 0
        for b in batches:
            for address in b.column(0).to_pylist():
                system, inner = file_system(address)
                with system.open_input_stream(inner) as f:
                    values.append(f.read())
                names.append(address.rsplit("/", 1)[-1])
                size += len(values[-1])
                if size >= BYTES_AT_ONCE or len(names) >= 10_000:
                    yield batch()
                    names, values, size = [], [], 0
        if names:
            yield batch()

    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    addresses = spark.createDataFrame(named, "address string, folder boolean").mapInArrow(listed, "address string")
    return addresses.repartition(tasks, "address").mapInArrow(opened, "name string, value binary")


FACT = "struct<concept:string,contextRef:string,unitRef:string,decimals:string,format:string,label:string,value:string>"
CONTEXT = "struct<entity:struct<scheme:string,identifier:string>,period:struct<instant:string,startDate:string,endDate:string>,dimensions:map<string,string>>"
UNIT = "struct<measures:struct<numerator:array<string>,denominator:array<string>>>"


def read_xbrl_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Facts (accession, section, ord, …), contexts and units of raw fact files, one file for each filing; see read_whole_files() for the path."""
    sections = ("balance_sheet", "income_statement", "cash_flow", "other")
    schema = ", ".join(f"{s} array<{FACT}>" for s in sections) + f", contexts map<string,{CONTEXT}>, units map<string,{UNIT}>"
    content = F.from_json(F.col("value").cast("string"), f"struct<{', '.join(x.replace(' ', ':', 1) for x in schema.split(', '))}>")
    text = read_whole_files(spark, path).select(F.regexp_replace("name", r"(\.xbrl)?\.json$", "").alias("accession"), content.alias("d"))
    each = F.array(*[F.struct(F.lit(s).alias("section"), F.col(f"d.{s}").alias("facts")) for s in sections])
    facts = text.select("accession", F.posexplode(each).alias("_n", "_s")).select("accession", "_n", "_s.section", F.posexplode("_s.facts").alias("_i", "f"))
    contexts = text.select("accession", F.explode("d.contexts").alias("contextRef", "c")).select("accession", "contextRef", "c.entity.scheme", "c.entity.identifier", "c.period.instant", "c.period.startDate", "c.period.endDate", "c.dimensions")
    units = text.select("accession", F.explode("d.units").alias("unitRef", "u")).select("accession", "unitRef", "u.measures.numerator", "u.measures.denominator")
    return facts.select("accession", "section", (F.col("_n") * 1_000_000 + F.col("_i")).alias("ord"), "f.*"), contexts, units


def read_adj_json(spark: SparkSession, path: str) -> DataFrame:
    """(accession, period, section, concept, value) of adjusted files; ticker, exchange and dei are no periods."""
    text = spark.read.text(path, wholetext=True).select(F.regexp_replace(file_name(), r"(\.xbrl)?(\.adj)?\.json$", "").alias("accession"), F.explode(F.variant_get(F.try_parse_json("value"), "$", "map<string,variant>")).alias("period", "v"))
    sections = text.where(~F.col("period").isin("ticker", "exchange", "dei")).select("accession", "period", F.explode(F.try_variant_get("v", "$", "map<string,variant>")).alias("section", "w"))
    return sections.select("accession", "period", "section", F.explode(F.try_variant_get("w", "$", "map<string,string>")).alias("concept", "value"))


def table(spark: SparkSession, root: str, product: str, name: str) -> DataFrame:
    """A product's table, or an empty one with its schema where nothing is stored yet."""
    return read_parquet_or_empty(spark, f"{root}/{product}/{name}", TABLES[name].schema())


def read_parquet_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, empty with its schema if the path does not exist."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.schema(schema).parquet(path) if exists else spark.createDataFrame([], schema)


def read_dataset_list(spark: SparkSession, path: str) -> DataFrame:
    """(code, title, description, version) of a list of data sets; codes and titles by the first known name, the title falling back to the code."""
    text = spark.read.text(path, wholetext=True)
    rows = text.select(F.explode(F.from_json("value", "array<map<string,string>>")).alias("m"))

    def pick(*names: str) -> Column:
        return F.coalesce(*[F.nullif(F.try_element_at("m", F.lit(n)), F.lit("")) for n in names])

    code = pick("code", "id", "ID", "dataflow_id", "indicator_code")
    return rows.select(code.alias("code"), F.coalesce(pick("title", "name", "Name", "label", "indicator_name"), code).alias("title"), pick("description", "desc").alias("description"), pick("version").alias("version")).where("code is not null")


def read_structures(spark: SparkSession, path: str) -> DataFrame:
    """(code, dimension, dimension_name, value, value_name) of data-set structures."""
    schema = "code string, dimensions array<struct<id:string,name:string,codes:array<struct<id:string,name:string>>>>"
    rows = spark.read.schema(schema).json(path, multiLine=True).select("code", F.explode("dimensions").alias("d"))
    return rows.select("code", F.col("d.id").alias("dimension"), F.col("d.name").alias("dimension_name"), F.explode_outer("d.codes").alias("c")).select("code", "dimension", "dimension_name", F.col("c.id").alias("value"), F.col("c.name").alias("value_name"))


def keywords(structures: DataFrame) -> DataFrame:
    """Each data set's dimensions as one text, in order."""
    return structures.groupBy("code").agg(F.array_join(F.array_sort(F.collect_set("dimension")), ", ").alias("keywords"))


def read_series_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(series_id, series_title, survey_name) of metadata entries that have a catalog with an id."""
    schema = "Results struct<series:array<struct<seriesID:string,catalog:struct<series_id:string,series_title:string,survey_name:string>>>>"
    rows = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("Results.series").alias("s"))
    return rows.where("s.catalog.series_id is not null").select("s.catalog.*")


def survey_lookup(surveys: DataFrame) -> DataFrame:
    """(survey, name) by trimmed upper-case abbreviation."""
    return surveys.select(F.upper(F.trim("survey_abbreviation")).alias("survey"), F.col("survey_name").alias("name")).where("survey <> ''").dropDuplicates(["survey"])
