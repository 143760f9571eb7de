"""Documents to lines, typed blocks, sections and token-bounded chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def lines(df: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, pos from 0, line) of every line."""
    return df.select(F.col(doc).alias("doc"), F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line"))


def text_blocks(df: DataFrame, doc: str, text: str) -> DataFrame:
    """Each non-blank line, stripped, as a paragraph."""
    return lines(df, doc, text).select("doc", "pos", F.lit("paragraph").alias("type"), T.strip(F.col("line")).alias("text")).where("text <> ''")


def markdown_blocks(df: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, pos, type, level, language, text) of Markdown blocks.

    Lines between two fences are one code block, at its opening fence; its language is taken from the
    closing fence, and a fence that is never closed gives no block. Other lines are blocks of their own.
    """
    is_fence = F.col("line").startswith("```")
    by_doc = Window.partitionBy("doc").orderBy("pos")
    fences = lines(df, doc, text).withColumn("fence", is_fence).withColumn("nth", F.sum(F.col("fence").cast("int")).over(by_doc.rowsBetween(Window.unboundedPreceding, 0)))
    inside = (F.col("nth") % 2 == 1) | F.col("fence")
    code = fences.where(inside).withColumn("block", F.floor((F.col("nth") + 1) / 2)).groupBy("doc", "block").agg(
        F.min("pos").alias("pos"), F.sum(F.col("fence").cast("int")).alias("n"), F.max(F.when(F.col("fence") & (F.col("nth") % 2 == 0), F.substring("line", 4, 1000))).alias("language"),
        F.array_sort(F.collect_list(F.when(~F.col("fence"), F.struct("pos", "line")))).alias("ls"),
    )
    code = code.where("n = 2").select("doc", "pos", F.lit("code").alias("type"), F.lit(0).alias("level"), T.strip(F.col("language")).alias("language"), F.array_join(F.transform("ls", lambda x: x["line"]), "\n").alias("text"))
    line, bare = F.col("line"), T.strip(F.col("line"))
    kind = (
        F.when(line.rlike(r"^#{1,6} "), "heading").when(bare.startswith("|"), "table_row").when(bare.rlike(r"^([-*+]|[0-9]+\.) "), "list_item").when(bare != "", "paragraph")
    )
    content = F.when(F.col("type") == "heading", T.strip(F.regexp_replace(line, r"^#{1,6} ", ""))).when(F.col("type") == "list_item", T.strip(F.regexp_replace(bare, r"^([-*+]|[0-9]+\.) ", ""))).otherwise(bare)
    other = fences.where(~inside).withColumn("type", kind).where("type is not null")
    level = F.when(F.col("type") == "heading", F.length(F.regexp_extract(line, r"^(#+)", 1))).otherwise(F.lit(0))
    return code.unionByName(other.select("doc", "pos", "type", level.alias("level"), F.lit(None).cast("string").alias("language"), content.alias("text")))


def html_text(c: Column) -> Column:
    """Tags as blanks, white space collapsed; text of scripts and styles stays."""
    return T.collapse(F.regexp_replace(c, r"<[^>]+>", " "))


def normalise_blocks(blocks: DataFrame) -> DataFrame:
    """Text redacted, then cleaned; redacted tells whether anything was replaced."""
    return blocks.withColumn("redacted", T.redaction_count(F.col("text")) > 0).withColumn("text", T.clean(T.redact(F.col("text"))))


def chunk_lengths(lengths: Column, most: int) -> Column:
    """Greedy packing of ordered lengths: array of struct(first, n, chars), a chunk each.

    A block opens a new chunk when the estimates (a quarter of the characters, rounded down) of what is
    there and of the block exceed most; each block adds its length and a newline; no block is split.
    """
    start = F.named_struct(F.lit("done"), F.array().cast("array<struct<first:int,n:int,chars:bigint>>"), F.lit("first"), F.lit(0), F.lit("n"), F.lit(0), F.lit("chars"), F.lit(0).cast("bigint"))

    def step(s, size):
        current = F.named_struct(F.lit("first"), s["first"], F.lit("n"), s["n"], F.lit("chars"), s["chars"])
        full = (F.floor(s["chars"] / 4) + F.floor(size / 4) > most) & (s["n"] > 0)
        return F.named_struct(
            F.lit("done"), F.when(full, F.concat(s["done"], F.array(current))).otherwise(s["done"]), F.lit("first"), F.when(full, s["first"] + s["n"]).otherwise(s["first"]),
            F.lit("n"), F.when(full, F.lit(1)).otherwise(s["n"] + 1), F.lit("chars"), F.when(full, size + 1).otherwise(s["chars"] + size + 1).cast("bigint"),
        )

    def end(s):
        last = F.named_struct(F.lit("first"), s["first"], F.lit("n"), s["n"], F.lit("chars"), s["chars"])
        return F.when(s["n"] > 0, F.concat(s["done"], F.array(last))).otherwise(s["done"])

    return F.aggregate(F.transform(lengths, lambda x: x.cast("bigint")), start, step, end)


def chunk_text(df: DataFrame, doc: str, text: str, most: int) -> DataFrame:
    """(doc, chunk from 1, text, token_estimate): non-blank lines of each text, packed in its row, without a shuffle."""
    ls = F.filter(F.transform(F.split(F.col(text), "\n"), lambda x: T.strip(x)), lambda x: x != "")
    packed = df.select(F.col(doc).alias("doc"), ls.alias("ls")).withColumn("chunks", chunk_lengths(F.transform("ls", lambda x: F.length(x)), most))
    one = packed.select("doc", "ls", F.posexplode("chunks").alias("i", "c"))
    joined = F.array_join(F.slice("ls", F.col("c.first") + 1, F.col("c.n")), "\n")
    return one.select("doc", (F.col("i") + 1).alias("chunk"), joined.alias("text"), F.floor(F.col("c.chars") / 4).cast("bigint").alias("token_estimate"))


def chunk_blocks(blocks: DataFrame, most: int) -> DataFrame:
    """Chunks of (doc, pos, type, level, text) blocks: a heading ends a chunk and heads the next; code is fenced."""
    by_doc = Window.partitionBy("doc").orderBy("pos")
    headed = blocks.withColumn("section", F.sum((F.col("type") == "heading").cast("int")).over(by_doc.rowsBetween(Window.unboundedPreceding, 0)))
    heading = F.max(F.when(F.col("type") == "heading", F.col("text"))).over(Window.partitionBy("doc", "section"))
    content = F.when(F.col("type") == "code", F.concat(F.lit("```\n"), F.col("text"), F.lit("\n```"))).otherwise(F.col("text"))
    body = headed.withColumn("heading", heading).where("type <> 'heading'").withColumn("text", content)
    grouped = body.groupBy("doc", "section", "heading").agg(F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("bs"))
    packed = grouped.withColumn("chunks", chunk_lengths(F.transform("bs", lambda b: F.length(b["text"])), most))
    one = packed.select("doc", "section", "heading", "bs", F.posexplode("chunks").alias("i", "c"))
    joined = F.array_join(F.transform(F.slice("bs", F.col("c.first") + 1, F.col("c.n")), lambda b: b["text"]), "\n")
    number = F.row_number().over(Window.partitionBy("doc").orderBy("section", "i"))
    out = one.select("doc", number.alias("chunk"), "heading", joined.alias("text"), F.floor(F.col("c.chars") / 4).cast("bigint").alias("token_estimate"))
    return out.withColumn("content_type", T.content_type(F.col("text")))


def heading_tree(blocks: DataFrame) -> DataFrame:
    """(doc, pos, level, title, parent): parent is the position of the nearest heading before of a lower level, null at the root."""
    headings = blocks.where("type = 'heading'").select("doc", "pos", "level", F.col("text").alias("title"))
    by_doc = Window.partitionBy("doc").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    # The last heading seen of each level, six at most, decides without a self join.
    last = [F.max(F.when(F.col("level") == k, F.col("pos"))).over(by_doc) for k in range(1, 7)]
    above = F.greatest(*[F.when(F.col("level") > k, last[k - 1]) for k in range(1, 7)], F.lit(None).cast("int"))
    return headings.select("*", above.alias("parent"))


def tables(blocks: DataFrame) -> DataFrame:
    """(doc, first, columns, rows): neighbouring table rows as one table, its first row as columns, rulers left out."""
    rows = blocks.where("type = 'table_row'").withColumn("run", F.col("pos") - F.row_number().over(Window.partitionBy("doc").orderBy("pos")))
    cells = F.transform(F.split(F.regexp_replace("text", r"^\||\|$", ""), r"\|"), lambda x: T.strip(x))
    real = rows.where(~F.col("text").rlike(r"^[|\s:-]+$")).select("doc", "run", "pos", cells.alias("cells"))
    grouped = real.groupBy("doc", "run").agg(F.array_sort(F.collect_list(F.struct("pos", "cells"))).alias("rs"))
    return grouped.select("doc", F.col("rs")[0]["pos"].alias("first"), F.col("rs")[0]["cells"].alias("columns"), F.transform(F.slice("rs", F.lit(2), F.size("rs")), lambda r: r["cells"]).alias("rows"))


def html_blocks(df: DataFrame, doc: str, html: str) -> DataFrame:
    """(doc, pos, type, level, text) of a page's headings, paragraphs, list items, code and table rows, in order; without scripts and styles."""
    bare = F.regexp_replace(F.coalesce(F.col(html), F.lit("")), r"(?is)<(script|style)\b.*?</\1>", " ")
    found = F.regexp_extract_all(bare, F.lit(r"(?is)(<(h[1-6]|p|li|pre|tr)\b[^>]*>.*?</\2>)"), F.lit(1))
    one = df.select(F.col(doc).alias("doc"), F.posexplode(found).alias("pos", "part")).withColumn("tag", F.lower(F.regexp_extract("part", r"^<(\w+)", 1)))
    kind = F.when(F.col("tag").startswith("h"), "heading").when(F.col("tag") == "li", "list_item").when(F.col("tag") == "pre", "code").when(F.col("tag") == "tr", "table_row").otherwise("paragraph")
    cells = F.transform(F.regexp_extract_all("part", F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"), F.lit(1)), html_text)
    text = F.when(kind == "table_row", F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))).otherwise(html_text(F.col("part")))
    level = F.when(kind == "heading", F.substring("tag", 2, 1).cast("int")).otherwise(F.lit(0))
    return one.select("doc", "pos", kind.alias("type"), level.alias("level"), text.alias("text")).where("text <> ''")


def parse(df: DataFrame, doc: str, kind: str, text: str) -> DataFrame:
    """Blocks of documents by their kind: Markdown, HTML, else plain lines. Rows go to one parser each."""
    of = lambda *k: df.where(F.coalesce(F.col(kind), F.lit("text")).isin(*k))
    plain = text_blocks(df.where(~F.coalesce(F.col(kind), F.lit("text")).isin("markdown", "html")), doc, text).withColumn("level", F.lit(0))
    columns = ("doc", "pos", "type", "level", "text")
    return markdown_blocks(of("markdown"), doc, text).select(*columns).unionByName(html_blocks(of("html"), doc, text).select(*columns)).unionByName(plain.select(*columns))
