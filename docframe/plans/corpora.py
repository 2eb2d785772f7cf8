"""Document corpora rendered from the relational test tables.

Every corpus covers its whole table and whole texts; what a query needs beside them
is put between, never in place of them. A document is a run of numbered pages,
each page one bounded text cell; no corpus gathers a whole document in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docframe.functions.text import money
from docframe.operators.ordered import number_rows
from docframe.session import written

ROWS_PER_PAGE = 5
PART_BLOCK = 1024
#: Items of an order that are numbered in one piece; those of larger orders are in blocks.
LARGE = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A scan in fewer pieces than there are cores, dealt out before text work.

    A large table comes in far more pieces than that and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


# --------------------------------------------------------------- invoices

ITEM_ORDER = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
    "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]


def large_orders(spark: SparkSession, sf_dir: str, most: int = LARGE) -> DataFrame:
    """(doc_id) of the orders with more than ``most`` items; written, so that joins know how few there are."""
    parts = table(spark, sf_dir, "part").groupBy("p_partkey").agg(F.count(F.lit(1)).alias("n"))
    repeated = written(parts.filter("n > 1"), "repeated")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), "l_partkey")
    sizes = lines.join(repeated, F.col("l_partkey") == F.col("p_partkey"), "left").groupBy("doc_id").agg(F.sum(F.coalesce("n", F.lit(1))).alias("n"))
    return written(sizes.filter(F.col("n") > most).select("doc_id"), "large")


def _among(rows: DataFrame, only: DataFrame | None) -> DataFrame:
    return rows if only is None else rows.join(only.select("doc_id"), "doc_id", "left_semi")


def _numbered_items(
    spark: SparkSession, sf_dir: str, most: int, only: DataFrame | None = None, large: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """The items of orders with up to ``most`` of them, placed by order, and those of larger ones, placed by block.

    With ``only`` those of its orders alone; ``large`` are the large orders where they are known.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "doc_id")
    lines = _among(lines.filter("doc_id IS NOT NULL"), only)
    large = large_orders(spark, sf_dir, most) if large is None else large
    named = lambda some: some.join(part, F.col("l_partkey") == F.col("p_partkey"))
    whole = F.row_number().over(Window.partitionBy("doc_id").orderBy(*ITEM_ORDER)).cast("long")
    blocks = {"line": F.col("l_linenumber"), "part": F.floor(F.col("l_partkey") / PART_BLOCK)}
    return (
        # Lines without a number count, before the others, and are left out, as in blocks.
        _shown(named(lines.join(large, "doc_id", "left_anti")).withColumn("rn", whole).filter("l_linenumber IS NOT NULL")),
        _shown(number_rows(named(lines.join(large, "doc_id", "left_semi")), ["doc_id"], blocks, ITEM_ORDER)),
    )


def _shown(numbered: DataFrame) -> DataFrame:
    return numbered.select(
        "doc_id",
        F.col("rn").cast("int").alias("rn"),
        (F.floor((F.col("rn") - 1) / ROWS_PER_PAGE) + 1).cast("int").alias("page_number"),
        F.col("p_name").alias("description"),
        money(F.col("l_quantity")).alias("quantity"),
        money(F.col("p_retailprice")).alias("unit_price"),
        money(F.col("l_extendedprice")).alias("amount"),
    )


def invoice_items(spark: SparkSession, sf_dir: str, most: int = LARGE) -> DataFrame:
    """Order lines numbered 1..n per order, with the page they stand on."""
    small, large = _numbered_items(spark, sf_dir, most)
    return small.unionByName(large)


def _gathered(items: DataFrame, line: Column) -> DataFrame:
    """(doc_id, page_number, rows): the lines of a page, at most ROWS_PER_PAGE, so this gathering is bounded."""
    rows = items.select("doc_id", "page_number", F.struct("rn", line.alias("line")).alias("r"))
    return rows.groupBy("doc_id", "page_number").agg(F.sort_array(F.collect_list("r")).alias("rows"))


def item_pages(spark: SparkSession, sf_dir: str, line: Column, most: int = LARGE) -> DataFrame:
    """(doc_id, page_number, rows): the items of each page in order, ``line`` each; those of an order with up to
    ``most`` items are brought together once, for the number and the page."""
    small, large = _numbered_items(spark, sf_dir, most)
    return _gathered(small, line).unionByName(_gathered(large, line))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, with the values an invoice shows."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf_dir, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("doc_id"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("invoice_date"),
            money(F.col("o_totalprice")).alias("total_amount"),
            "o_orderstatus",
            "o_orderpriority",
            "c_name",
            "c_nationkey",
            "n_name",
        )
    )


def source_file() -> Column:
    return F.concat(F.lit("invoice_"), F.col("doc_id").cast("string"), F.lit(".pdf"))


def invoice_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order that has lines, with its file and number of pages."""
    counts = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("doc_id"))
        .agg(F.count(F.lit(1)).alias("n_items"))
    )
    pages = F.ceil(F.col("n_items") / ROWS_PER_PAGE).cast("int").alias("page_count")
    return _orders(spark, sf_dir).join(counts, "doc_id").select("*", pages, source_file().alias("source_file"))


def _invoice_head() -> Column:
    k = F.col("doc_id").cast("string")
    return F.concat_ws(
        "\n",
        F.lit("---"),
        F.concat(F.lit("titolo: Invoice INV-"), k),
        F.concat(F.lit("comune: "), "n_name"),
        F.lit("tipo: Invoice"),
        F.concat(F.lit("anno: "), F.substring("invoice_date", 1, 4)),
        F.lit("---"),
        F.lit("# INVOICE"),
        F.lit(""),
        F.concat(F.lit("Invoice Number: INV-"), k),
        F.concat(F.lit("Invoice Date: "), "invoice_date"),
        F.concat(F.lit("Vendor Name: Vendor-"), F.col("c_nationkey").cast("string")),
        F.concat(F.lit("Client Name: "), "c_name"),
        F.concat(F.lit("Payment Terms: "), "o_orderpriority"),
        F.concat(F.lit("Status = "), "o_orderstatus"),
        F.concat(F.lit("Reference - R"), k),
        F.lit(""),
        F.col("table_md"),
    )


def invoice_pages(spark: SparkSession, sf_dir: str, most: int = LARGE, only: DataFrame | None = None) -> DataFrame:
    """(doc_id, page_number, source_file, md): one invoice per order.

    Items are gathered by page, five to a page. Orders with up to ``most`` items
    are brought together once and meet their values there; of larger ones only
    first pages meet them, by document and page, so an order with very many lines
    is spread. With ``only`` (doc_id) no other order's items are numbered or rendered; a filter on the pages gets
    below the numbering only where its ids are few enough to be broadcast.
    """
    small, large = _rendered_pages(spark, sf_dir, most, only)
    return small.unionByName(large)


def pages_by_size(spark: SparkSession, sf_dir: str, most: int = LARGE) -> list[tuple[DataFrame, bool]]:
    """The invoice pages in sets (pages, together): those of orders with up to ``most`` items, which lie together, and,
    if there are any, those of larger ones, which are spread."""
    ids = large_orders(spark, sf_dir, most)
    small, large = _rendered_pages(spark, sf_dir, most, None, ids)
    return [(small, True)] if ids.isEmpty() else [(small, True), (large, False)]


def _rendered_pages(
    spark: SparkSession, sf_dir: str, most: int, only: DataFrame | None, large: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    k = F.col("doc_id")
    cells = F.when(
        (k % 9 == 0) & (F.col("rn") == 1), F.array("description", "quantity", "unit_price")
    ).otherwise(F.array("description", "quantity", "unit_price", "amount"))
    row = F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    body = F.array_join(F.transform("rows", lambda r: r["line"]), "\n")
    header = F.lit("| Description | Quantity | Unit Price | Amount |\n| --- | --- | --- | --- |\n")
    tail = F.concat(
        F.when(k % 10 == 0, F.lit("")).otherwise(
            F.concat(F.lit("\n\nTotal Amount: "), "total_amount")
        ),
        F.when(k % 7 == 0, F.concat(F.lit("\n\nInvoice Number: INV-"), k, F.lit("-R"))).otherwise(
            F.lit("")
        ),
    )
    first = F.concat(_invoice_head(), tail)
    small, large = _numbered_items(spark, sf_dir, most, only, large)
    heads = _among(_orders(spark, sf_dir), only)

    def rendered(items: DataFrame, heads: DataFrame, on: Column) -> DataFrame:
        tables = _gathered(items, row).select(
            "doc_id",
            "page_number",
            F.when(k % 4 == 0, body).otherwise(F.concat(header, body)).alias("table_md"),
        )
        return tables.join(heads, on, "left").select(
            "doc_id",
            "page_number",
            source_file().alias("source_file"),
            F.when(F.col("page_number") == 1, first)
            .otherwise(F.concat(F.lit("Continued\n\n"), F.col("table_md")))
            .alias("md"),
        )

    same, first_page = k == F.col("_order"), F.col("page_number") == F.col("_page")
    heads = heads.withColumnRenamed("doc_id", "_order")
    by_page = heads.withColumn("_page", F.lit(1))
    return rendered(small, heads, same & (F.col("page_number") == 1)), rendered(large, by_page, same & first_page)


# --------------------------------------------------------------- markdown

def md_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, md): every line of the documents, with front matter, headings, tables, lists, images and marks between."""
    decorated = F.expr(
        """flatten(transform(lines, (line, pos) -> concat(
             CASE WHEN pos = 0 THEN array()
             WHEN (doc_id * 31 + pos * 17) % 13 = 0 THEN array(concat('## Parte ', pos))
             WHEN (doc_id * 31 + pos * 17) % 13 = 1 THEN array(concat('### Capo ', pos))
             WHEN (doc_id * 31 + pos * 17) % 13 = 2 THEN array(concat('#### Voce ', pos))
             WHEN (doc_id * 31 + pos * 17) % 13 = 3 THEN array(concat('##### Nota ', pos))
             WHEN (doc_id * 31 + pos * 17) % 13 = 4 THEN array('')
             WHEN (doc_id * 31 + pos * 17) % 13 = 5 THEN array(
               concat('| ', replace(line, '|', ''), ' |  | x', pos, ' |'), '|---|---|---|',
               CASE WHEN pos % 4 = 0 THEN '| uno | due |' ELSE '| uno | *due* | tre |' END)
             WHEN (doc_id * 31 + pos * 17) % 13 = 6 THEN array('|---|---|')
             WHEN (doc_id * 31 + pos * 17) % 13 = 9 THEN array(
               CASE WHEN pos % 2 = 0 THEN '![a](img/p.png)' ELSE '![b](http://x/p.png)' END)
             WHEN (doc_id * 31 + pos * 17) % 13 = 10 THEN array(concat('<!-- UNREADABLE: page ', pos, ' -->'))
             ELSE array() END,
             array(CASE WHEN pos = 0 THEN concat('# ', line)
             WHEN (doc_id * 31 + pos * 17) % 13 = 7 THEN concat('- ', line)
             WHEN (doc_id * 31 + pos * 17) % 13 = 8 THEN concat('**', line, '**')
             ELSE line END))))"""
    )
    front = F.expr(
        """CASE doc_id % 3
             WHEN 0 THEN array('---', concat('titolo: Documento ', doc_id), 'comune: Como', concat('tipo: ', lang),
               'anno: 2020', '---', '')
             WHEN 1 THEN array('---', concat('titolo: Documento ', doc_id), 'anno: 2020', '---')
             ELSE array() END"""
    )
    return (
        spread(table(spark, sf_dir, "documents"))
        .select("doc_id", "lang", F.split("text", "\n").alias("lines"))
        .select("doc_id", F.array_join(F.concat(front, decorated), "\n").alias("md"))
    )


def raw_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, lang, text): every line of the documents, with page numbers, notices, TOC and legal lines between."""
    decorated = F.expr(
        """flatten(transform(lines, (line, pos) -> concat(
             CASE WHEN pos % 11 = 10 THEN array(cast(pos AS string))
             WHEN pos % 13 = 12 THEN array(concat('Rilascio della autorizzazione ', pos, ' dalla autorità competente'))
             WHEN pos % 17 = 16 THEN array(concat('Copyright ', doc_id))
             WHEN pos % 19 = 18 THEN array(concat('ART. ', pos, ' ........ ', pos))
             WHEN pos % 23 = 22 THEN array(concat('TITOLO ', pos))
             WHEN pos % 29 = 28 THEN array(concat('ART. ', pos, ' Disposizioni'))
             WHEN pos % 31 = 30 THEN array(concat(pos, '.1 Generale'))
             WHEN pos % 37 = 36 THEN array('È vietato il deposito')
             WHEN pos % 41 = 40 THEN array('Autori: A. Rossi')
             WHEN pos % 43 = 42 THEN array('Vietata la riproduzione anche parziale')
             ELSE array() END, array(line))))"""
    )
    return (
        spread(table(spark, sf_dir, "documents"))
        .select("doc_id", "source", "lang", F.split("text", "\n").alias("lines"))
        .select("doc_id", "source", "lang", F.array_join(decorated, "\n").alias("text"))
    )


# ---------------------------------------------------------- page fragments

def fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source_file, page_number, page_md): model output, one row per page."""
    c, p = F.col("doc_id"), F.col("page_number")
    num = lambda x: x.cast("string")
    entries = F.concat(
        F.when(c % 5 == 1, F.lit("")).otherwise(
            F.concat(F.lit("titolo: Conversation "), num(c), F.lit("\n"))
        ),
        F.when(c % 6 == 2, F.lit("comune:\n")).otherwise(
            F.concat(F.lit("comune: CITTA-"), num(c % 4), F.lit("\n"))
        ),
        F.lit("tipo: Chat\n"),
        F.when(c % 2 == 0, F.concat(F.lit("anno: "), num(2010 + c % 10), F.lit("\n"))).otherwise(
            F.lit("")
        ),
    )
    block = F.when(
        c % 4 == 1, F.concat(F.lit("```yaml\n"), entries, F.lit("```\n\n"))
    ).otherwise(F.concat(F.lit("---\n"), entries, F.lit("---\n\n")))
    front = F.when((p == 1) & (c % 3 != 0), block).when(
        (p == 2) & (c % 5 == 0), F.lit("---\nstray: yes\n---\n")
    ).otherwise(F.lit(""))
    title = F.when((p == 1) & (c % 7 != 0), F.concat(F.lit("# Doc "), num(c), F.lit("\n\n"))).otherwise(
        F.lit("")
    )
    heading = F.when(
        p % 3 == 2, F.concat(F.lit("#### Sezione "), num(p), F.lit("\n\n"))
    ).when(p % 3 == 0, F.concat(F.lit("## Capitolo "), num(p), F.lit("\n\n"))).otherwise(F.lit(""))
    years = F.when(
        c % 2 == 1,
        F.concat(
            F.lit(" Anno "), num(2010 + (c + p) % 5), F.lit(". L.R. 12/"), num(2005 + p), F.lit(".")
        ),
    ).otherwise(F.lit(""))
    turns = spread(table(spark, sf_dir, "conversations")).select(
        F.col("conv_id").alias("doc_id"),
        # some conversations have an empty page far behind the others
        F.explode(
            F.when((F.col("turn") == 0) & (F.col("conv_id") % 8 == 0), F.array((F.col("turn") + 1).cast("int"), F.lit(5000)))
            .otherwise(F.array((F.col("turn") + 1).cast("int")))
        ).alias("page_number"),
        "text",
    )
    return turns.select(
        "doc_id",
        F.concat(F.lit("chat_"), num(c), F.lit(".pdf")).alias("source_file"),
        "page_number",
        F.when(p == 5000, F.lit("")).otherwise(F.concat(front, title, heading, F.col("text"), years)).alias("page_md"),
    )


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page_number, text, extraction_method): a page per turn, with blank and near-empty pages between."""
    c, p = F.col("conv_id"), (2 * F.col("turn") + 1).cast("int")
    page = lambda number, text: F.struct(number.cast("int").alias("page_number"), text.alias("text"))
    extra = (
        F.when((c + p) % 8 == 0, F.lit(" \n\t "))
        .when((c + p) % 8 == 3, F.concat(F.lit(" - "), (p + 1).cast("string"), F.lit(" - ")))
    )
    pages = F.when(extra.isNull(), F.array(page(p, F.col("text")))).otherwise(F.array(page(p, F.col("text")), page(p + 1, extra)))
    return spread(table(spark, sf_dir, "conversations")).select(
        c.alias("doc_id"),
        F.inline(pages),
        F.when(c % 2 == 0, F.lit("pymupdf")).otherwise(F.lit("docling")).alias("extraction_method"),
    ).select("doc_id", "page_number", "text", "extraction_method")


# ---------------------------------------------------------- model responses

def document_type() -> Column:
    """Every third document is a shipment, the others are invoices."""
    return F.when(F.col("doc_id") % 3 == 2, "shipment").otherwise("invoice")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, document_type, raw): a model's JSON answer per order; some are broken, some repeat a key."""
    k = F.col("o_orderkey")
    s = k.cast("string")
    ship = k % 3 == 2
    items = F.expr(
        """transform(sequence(0, cast(o_orderkey % 4 AS int)), i ->
             CASE WHEN o_orderkey % 3 = 2 THEN concat('{"goods": "Pallet ', i, '", "pallets": ', (o_orderkey + i) % 50)
             ELSE concat('{"description": "Item ', i, '", "quantity": ', (o_orderkey + i) % 50,
               ', "amount": "', o_orderkey % 1000, '.', 10 + i, '"') END
             || CASE WHEN o_orderkey % 9 = 0 THEN ', "junk": 1}' ELSE '}' END)"""
    )
    items = F.when(k % 8 == 0, F.concat(F.array(F.lit('"not_a_dict"')), items)).otherwise(items)
    confidence = (
        F.when(k % 13 == 0, F.lit('"high"'))
        .when(k % 14 == 0, F.lit("1.7"))
        .when(k % 15 == 0, F.lit("true"))
        .when(k % 16 == 0, F.lit('"true"'))
        .when(k % 18 == 0, F.lit('"0.9d"'))
        .when(k % 19 == 0, F.lit('"0.75"'))
        .otherwise(F.concat(F.lit("0."), F.lpad((k % 100).cast("string"), 2, "0")))
    )
    party = F.when(k % 6 == 0, F.lit("  ")).otherwise(F.concat(F.lit("Vendor-"), (k % 25).cast("string")))
    number = F.when(ship, F.lit("load_number")).otherwise("invoice_number")
    fields = F.concat(
        F.when(k % 23 == 0, F.concat(F.lit('"'), number, F.lit('": "OLD", '))).otherwise(""),
        F.lit('"'), number, F.lit('": "INV-'), s, F.lit('", '),
        F.when(ship, F.lit("")).otherwise(
            F.concat(F.lit('"invoice_date": "'), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit('", '))
        ),
        F.when(ship, F.lit('"carrier": "')).otherwise('"vendor_name": "'), party, F.lit('"'),
        F.when(k % 5 == 0, F.lit("")).otherwise(
            F.concat(F.lit(', "total_amount": '), money(F.col("o_totalprice")))
        ),
        F.when(k % 7 == 0, F.lit(', "bogus_field": "b"')).otherwise(F.lit("")),
        F.when(ship, F.lit(', "pickup_date": null')).otherwise(', "client_name": null'),
    )
    own = (
        F.when(k % 10 == 3, F.lit('"low contrast"'))
        .when(k % 10 == 6, F.lit('"Line item 3 has no readable price", "Required field missing on page 2"'))
        .otherwise("")
    )
    body = F.concat(
        F.lit('{"document_type": "whatever", "fields": {'), fields, F.lit('}, "line_items": ['),
        F.array_join(items, ", "), F.lit('], "confidence": '), confidence, F.lit(', "warnings": ['), own, F.lit("]}"),
    )
    raw = (
        F.when(k % 11 == 0, F.lit("Sorry, no data"))
        .when(k % 12 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .otherwise(body)
    )
    return spread(table(spark, sf_dir, "orders")).select(k.alias("doc_id"), raw.alias("raw")).select(
        "doc_id", document_type().alias("document_type"), "raw"
    )


# ---------------------------------------------------------- layout

def layout_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page_number, block_no, x0..y1, text): text blocks of order pages."""
    x, y = F.col("l_partkey") % 500, F.col("l_suppkey") * 7 % 700
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"),
        (1 + F.col("l_linenumber") % 2).cast("int").alias("page_number"),
        (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("block_no"),
        x.cast("double").alias("x0"),
        y.cast("double").alias("y0"),
        (x + F.col("l_quantity")).cast("double").alias("x1"),
        (y + 10).cast("double").alias("y1"),
        F.when((F.col("l_partkey") + F.col("l_linenumber")) % 6 == 5, F.lit(" "))
        .otherwise(F.concat(F.lit("part: "), F.col("l_partkey").cast("string")))
        .alias("text"),
    )


def table_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page_number, x0..y1): boxes of the tables found on order pages."""
    box = lambda n, a, b, c, d: F.struct(
        F.lit(n).alias("table_no"),
        *[F.lit(float(v)).alias(k) for k, v in (("x0", a), ("y0", b), ("x1", c), ("y1", d))],
    )
    big, small = box(1, 50, 50, 350, 500), box(2, 400, 600, 480, 680)
    boxes = F.when(F.col("o_orderkey") % 5 == 0, F.array(big, small)).otherwise(F.array(big))
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderkey") % 3 != 0)
        .select(
            F.col("o_orderkey").alias("doc_id"),
            F.explode(F.array(F.lit(1), F.lit(2))).alias("page_number"),
            boxes.alias("boxes"),
        )
        .select("doc_id", "page_number", F.inline("boxes"))
    )


def layout_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_no, prov, text): layout items citing one or two pages."""
    rn = F.col("rn")
    prov = F.when(rn % 4 == 0, F.array(F.lit(1), F.lit(2), F.lit(1))).otherwise(
        F.array((1 + rn % 2).cast("int"))
    )
    return invoice_items(spark, sf_dir).select(
        "doc_id",
        rn.alias("item_no"),
        prov.alias("prov"),
        F.when(rn % 5 == 0, F.lit("")).otherwise(F.col("description")).alias("text"),
    )


# ---------------------------------------------------------- extraction candidates

def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, method, page_number, text): up to three extractions per web page."""
    i = F.col("page_id")
    article = F.regexp_replace(
        F.regexp_extract("html", r"(?s)<article>(.*?)</article>", 1), r"<[^>]*>", " "
    )
    title = F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)
    options = F.array(
        # a primary extraction of every third page finds the headline alone
        F.when(i % 7 != 0, F.struct(F.lit("primary").alias("method"), F.when(i % 3 == 0, title).otherwise(article).alias("text"))),
        F.struct(
            F.lit("secondary").alias("method"),
            F.when(i % 5 == 0, F.lit("  ")).otherwise(article).alias("text"),
        ),
        F.struct(
            F.lit("ocr").alias("method"),
            F.when(i % 10 == 0, F.lit("")).otherwise(title).alias("text"),
        ),
    )
    return (
        spread(table(spark, sf_dir, "pages"))
        .select(i.alias("doc_id"), F.explode(F.filter(options, lambda o: o.isNotNull())).alias("o"))
        .select("doc_id", "o.method", F.lit(1).alias("page_number"), "o.text")
    )


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_bytes): size of each web page in bytes."""
    return spread(table(spark, sf_dir, "pages")).select(
        F.col("page_id").alias("doc_id"), F.octet_length("html").cast("long").alias("n_bytes")
    )


# ---------------------------------------------------------- run log

def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per input file of a batch, with the outcome of its run."""
    e, failed = F.col("event_id"), F.col("event_type") == "error"
    suffix = F.when(e % 10 == 8, F.lit(".PDF")).when(e % 10 == 9, F.lit(".md")).otherwise(F.lit(".pdf"))
    methods = F.when(F.col("user_id") % 2 == 0, F.array(F.lit("pymupdf"))).otherwise(
        F.array(F.lit("pymupdf"), F.lit("llm"))
    )
    return table(spark, sf_dir, "events").select(
        e.alias("doc_id"),
        F.concat(F.lit("doc_"), F.lpad(e.cast("string"), 9, "0"), suffix).alias("source_file"),
        F.when(failed, F.lit("failed")).otherwise(F.lit("success")).alias("status"),
        F.when(~failed, (1 + e % 9).cast("int")).otherwise(F.lit(0)).alias("pages"),
        F.when(~failed, (e % 4).cast("int")).otherwise(F.lit(0)).alias("tables_found"),
        F.when(~failed, (e % 21).cast("int")).otherwise(F.lit(0)).alias("fields_found"),
        F.when(~failed, (e % 3).cast("int")).otherwise(F.lit(0)).alias("warnings_count"),
        F.slice(
            F.array(F.lit("EMPTY_DOCUMENT"), F.lit("RAGGED_TABLE")), F.lit(1), F.when(~failed, e % 3).otherwise(0).cast("int")
        ).alias("warning_codes"),
        F.when(~failed, (e % 101) / 100.0).alias("confidence"),
        F.when(failed, F.lit(1)).otherwise(F.lit(0)).alias("errors_count"),
        F.col("value").cast("decimal(18,2)").alias("processing_seconds"),
        methods.alias("extraction_methods"),
        F.when(failed & (e % 3 == 0), F.lit("429 quota"))
        .when(failed & (e % 3 == 1), F.lit("RESOURCE_EXHAUSTED"))
        .when(failed, F.lit("timeout"))
        .alias("error_message"),
        F.when(e % 97 != 0, e * 7919 % 41943040).alias("n_bytes"),
        F.when(F.col("user_id") % 3 == 0, F.lit("invoice"))
        .when(F.col("user_id") % 3 == 1, F.lit("logistics"))
        .alias("profile"),
        (e % 3 != 0).alias("has_document"),
        (e % 4 != 0).alias("has_record"),
    )


# Profiles of a batch manifest and the document type each stands for.
PROFILES = {"invoice": "invoice", "logistics": "shipment"}
