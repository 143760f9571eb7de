"""Questions asked of symbol graphs, for many symbols at once: look-ups, best matches, traces, cards and context blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from . import graph as G
from .scoring import contained
from . import search as Q

BRIEF = ("id", "name", "kind", "file_path")


def find_symbol(nodes: DataFrame, symbol: str, exact: bool = True) -> DataFrame:
    """Nodes of a name, or whose name contains it whatever the case."""
    return nodes.where(F.col("name") == symbol if exact else F.lower("name").contains(symbol.lower()))


def find_by(nodes: DataFrame, kind: str = "", file: str = "") -> DataFrame:
    out = nodes.where(F.col("kind") == kind) if kind else nodes
    return out.where(F.col("file_path") == file) if file else out


def combined(nodes: DataFrame, term: str) -> DataFrame:
    """Nodes by name, kind or path, with what met the term first."""
    low = F.lit(term.lower())
    met = F.when(F.lower("name").contains(low), "name").when(F.col("kind") == term, "kind").when(F.lower("file_path").contains(low), "path")
    return nodes.withColumn("met", met).where("met is not null")


def node_rows(nodes: DataFrame, ids: DataFrame) -> DataFrame:
    """Nodes of a table of ids; what a node lacks is empty."""
    kept = nodes.join(ids.select("id").distinct(), "id", "left_semi")
    return kept.na.fill("").na.fill(0)


def best_symbols(nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """The best node of each wanted (query_id, symbol, near): exact 10, near file 25 or name in path 12, types 5, generated -20; ties by id.

    Nodes and queries of one name don't all meet. Apart from exactness and near files a node's score is its own,
    so of each spelling the best node stands for all; near files are looked for by their text, once for
    each different one, and the best node of each spelling there stands for the others too.
    """
    path, low = F.coalesce("file_path", F.lit("")), F.lower("name")
    kind = F.when(F.col("kind").isin("class", "interface"), 5).otherwise(0) - F.when(F.lower(path).rlike("swagger|generated"), 20).otherwise(0)
    scored = nodes.where("name is not null").select(low.alias("_low"), F.struct(*nodes.columns).alias("_node"), (kind + F.when(F.lower(path).contains(low), 12).otherwise(0)).alias("_far"), (kind + 25).alias("_near"))
    first = lambda score: F.min_by(F.struct("_node", F.col(score).alias("score")), F.struct(-F.col(score), F.col("_node.id"))).alias("b")
    asked = wanted.select(F.lower("symbol").alias("_low"), "symbol", F.coalesce("near", F.lit("")).alias("near")).where("symbol is not null").distinct()
    scored = scored.join(asked.select("_low"), "_low", "left_semi")  # of names that nobody asks for no best is looked for
    exact = F.when(F.col("b._node.name") == F.col("symbol"), 10).otherwise(0)
    best = lambda met, *by: met.withColumn("score", F.col("b.score") + exact).groupBy(*by).agg(F.min_by(F.struct("b._node", "score"), F.struct(-F.col("score"), F.col("b._node.id"))).alias("b"))
    far = best(asked.select("_low", "symbol").distinct().join(scored.groupBy("_low", "_node.name").agg(first("_far")), "_low"), "symbol")
    places = asked.where("near <> ''").select(F.col("_low").alias("_asked"), "near").distinct()
    held = contained(scored.withColumn("_path", F.coalesce("_node.file_path", F.lit(""))), "_path", places, "near", ("_low", "_asked"))
    close = best(asked.join(held.groupBy("_low", "near", "_node.name").agg(first("_near")), ["_low", "near"]), "symbol", "near")
    every = wanted.join(far, "symbol").unionByName(wanted.join(close, ["symbol", "near"]))
    n = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("b.score"), "b._node.id"))
    return every.withColumn("_n", n).where("_n = 1").select(*wanted.columns, "b._node.*", F.col("b.score").alias("rank_score"))


def first_symbols(nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """The first node by id of each wanted (query_id, symbol)."""
    met = wanted.join(nodes.select(F.col("name").alias("symbol"), "id"), "symbol")
    return met.groupBy("query_id", "symbol").agg(F.min("id").alias("id"))


def brief(found: DataFrame, nodes: DataFrame, node: str = "node") -> DataFrame:
    """found with name, kind and file of its node; ids that no node has are left out."""
    return found.join(nodes.select(F.col("id").alias(node), *BRIEF[1:]), node)


def trace(nodes: DataFrame, edges: DataFrame, wanted: DataFrame, depth: int = 2) -> DataFrame:
    """(query_id, start, direction, node, depth, name, kind, file_path) of the best symbols of wanted(query_id, symbol, near, direction), 1 to 6 steps."""
    depth = min(6, max(1, depth))
    asked = G.cut(best_symbols(nodes, wanted).select("query_id", F.col("id").alias("start"), "direction"))
    pairs, out = G.walked(edges), None
    for direction, ahead in (("callers", G.turned(pairs)), ("callees", pairs)):
        own = asked.where(F.col("direction").isin(direction, "both"))
        found = own.drop("direction").join(G.reach(ahead, own.select(F.col("start").alias("node")).distinct(), depth), "start").withColumn("direction", F.lit(direction))
        out = found if out is None else out.unionByName(found)
    return brief(out, nodes)


def trace_to(nodes: DataFrame, edges: DataFrame, pairs: DataFrame, most_nodes: int = 12, most_paths: int = 3) -> DataFrame:
    """Paths between the best symbols of pairs(query_id, from_symbol, to_symbol)."""
    ends = [best_symbols(nodes, pairs.select("query_id", F.col(c).alias("symbol"), F.lit("").alias("near"))).select("query_id", F.col("id").alias(n)) for c, n in (("from_symbol", "start"), ("to_symbol", "target"))]
    asked = ends[0].join(ends[1], "query_id")
    walks = G.walked(edges, paths=True)
    paths = G.shortest_paths(walks, asked.select(F.col("start").alias("node")).distinct(), asked.select(F.col("target").alias("node")).distinct(), most_nodes, most_paths)
    return asked.join(paths, ["start", "target"]).select("query_id", "start", "target", G.format_path(F.col("path")).alias("summary"), "length")


def entry_starts(nodes: DataFrame, hints: DataFrame) -> DataFrame:
    """The first entry node of each (query_id, hint, file): whose name or id holds the hint, else in the same file."""
    entries = nodes.where(F.col("kind").isin("route", "entrypoint", "job"))
    named = entries.select("id", F.lower(F.concat_ws(" ", "id", "name")).alias("_names"))
    by_hint = contained(named, "_names", hints.select("query_id", F.lower("hint").alias("_hint")), "_hint").select("query_id", F.lit(0).alias("tier"), "id")
    by_file = hints.join(entries, F.col("file") == F.col("file_path")).select("query_id", F.lit(1).alias("tier"), "id")
    return by_hint.unionByName(by_file).groupBy("query_id").agg(F.min(F.struct("tier", "id")).alias("b")).select("query_id", F.col("b.id").alias("start"))


def impact_of(nodes: DataFrame, edges: DataFrame, wanted: DataFrame, depth: int = 2) -> DataFrame:
    """Callers and callees of the first node of each wanted symbol."""
    asked = G.cut(first_symbols(nodes, wanted))
    found = G.impact(edges, asked.select(F.col("id").alias("node")).distinct(), depth)
    return asked.withColumnRenamed("id", "start").join(found, "start")


def _names(found: DataFrame, nodes: DataFrame, by: list[str], most: int | None, name: str) -> DataFrame:
    n = F.row_number().over(Window.partitionBy(*by).orderBy("depth", "node"))
    kept = found.withColumn("_n", n).where(F.col("_n") <= most) if most else found.withColumn("_n", n)
    named = kept.join(nodes.select(F.col("id").alias("node"), "name"), "node")
    return named.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", "name"))), lambda x: x["name"]).alias(name))


def neighbour_names(nodes: DataFrame, edges: DataFrame, starts: DataFrame, depth: int, most: int) -> DataFrame:
    """starts(id) with the names of its callers and callees, nearest first, most each."""
    start = starts.select(F.col("id").alias("node")).distinct()
    pairs, out = G.walked(edges), starts
    for name, ahead in (("callers", G.turned(pairs)), ("callees", pairs)):
        out = out.join(_names(G.reach(ahead, start, depth), nodes, ["start"], most, name).withColumnRenamed("start", "id"), "id", "left")
    none = F.array().cast("array<string>")
    return out.withColumns({c: F.coalesce(c, none) for c in ("callers", "callees")})


def explore(nodes: DataFrame, edges: DataFrame, files: DataFrame, wanted: DataFrame, most_lines: int = 80, most: int = 20) -> DataFrame:
    """A card of each wanted symbol's best node: its row, callers and callees to two steps, and its source."""
    best = best_symbols(nodes, wanted)
    cards = neighbour_names(nodes, edges, best, 2, most)
    return with_source(cards, files, most_lines)


def with_source(nodes: DataFrame, files: DataFrame, most_lines: int) -> DataFrame:
    """nodes with source: their lines, most_lines at most."""
    own = G.shuffled(files.select(F.col("path").alias("file_path"), F.split("text", "\n").alias("_lines")))
    size = F.least(F.lit(most_lines), F.greatest(F.lit(1), F.col("end_line") - F.col("start_line") + 1))
    return nodes.join(own, "file_path", "left").withColumn("source", F.coalesce(F.array_join(F.slice("_lines", F.col("start_line"), size), "\n"), F.lit(""))).drop("_lines")


def build_context(nodes: DataFrame, edges: DataFrame, files: DataFrame, query: str, most_blocks: int = 8, most_lines: int = 40, neighbours: int = 5) -> DataFrame:
    """The best hit of each file for a query as typed, most_blocks of them, with snippet and nearest callers and callees."""
    hits = Q.search(nodes, Q.parse_query(query), 2 * most_blocks)
    first = F.row_number().over(Window.partitionBy("file_path").orderBy(F.desc("score"), "id"))
    blocks = hits.withColumn("_n", first).where("_n = 1").drop("_n").orderBy(F.desc("score"), "id").limit(most_blocks)
    return with_source(neighbour_names(nodes, edges, blocks, 1, neighbours), files, most_lines)


def context_markdown(blocks: DataFrame) -> DataFrame:
    """One row: all blocks as Markdown, best first. Blocks are few by build_context's limit."""
    lines = lambda label, c: F.when(F.size(c) > 0, F.concat(F.lit(f"{label}: "), F.array_join(c, ", ")))
    text = F.concat_ws("\n", F.concat(F.lit("### "), F.col("name"), F.lit(" ("), F.col("file_path"), F.lit(")")), F.concat(F.lit("```\n"), F.col("source"), F.lit("\n```")), lines("callers", "callers"), lines("callees", "callees"))
    one = blocks.select(F.struct(-F.col("score"), "id", text.alias("t")).alias("b")).agg(F.array_sort(F.collect_list("b")).alias("bs"))
    return one.select(F.array_join(F.transform("bs", lambda b: b["t"]), "\n\n").alias("markdown"))


def list_files(nodes: DataFrame, patterns=("*",), limit: int = 100, repo: str | None = None) -> DataFrame:
    """Paths that match, in order; of several repositories each gives limit over their number, three at least."""
    files = nodes.where(T.matches_any(F.col("file_path"), patterns)).select(*([repo] if repo else []), "file_path").distinct()
    if not repo:
        return files.orderBy("file_path").limit(limit)
    each = files.withColumn("_n", F.row_number().over(Window.partitionBy(repo).orderBy("file_path"))).crossJoin(F.broadcast(files.agg(F.count_distinct(repo).alias("_repos"))))  # one row
    return each.where(F.col("_n") <= F.greatest(F.floor(F.lit(limit) / F.col("_repos")), F.lit(3))).drop("_n", "_repos").orderBy(repo, "file_path").limit(limit)


def repo_stats(nodes: DataFrame, edges: DataFrame, repo: str = "repo") -> DataFrame:
    """Nodes, edges and files of each repository, and of all as 'total', in one grouping."""
    rows = nodes.select(repo, F.lit(1).alias("n"), F.lit(0).alias("e"), F.col("file_path").alias("f")).unionByName(edges.select(repo, F.lit(0).alias("n"), F.lit(1).alias("e"), F.lit(None).cast("string").alias("f")))
    out = rows.rollup(repo).agg(F.sum("n").alias("nodes"), F.sum("e").alias("edges"), F.count_distinct("f").alias("files"), F.grouping(repo).alias("_all"))
    return out.select(F.when(F.col("_all") == 1, "total").otherwise(F.col(repo)).alias(repo), "nodes", "edges", "files")


def attach_entry_points(nodes: DataFrame, edges: DataFrame, entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New route nodes 'entry:<kind>:<handler>' of (kind, handler, path) whose handler is a node, and entry_to edges; known ids are not added again."""
    known = entries.join(nodes.select(F.col("id").alias("handler"), "file_path"), "handler").withColumn("id", F.concat_ws(":", F.lit("entry"), "kind", "handler"))
    new = known.join(nodes.select("id"), "id", "left_anti")
    name = F.when(F.coalesce("path", F.lit("")) != "", F.col("path")).otherwise(F.col("handler"))
    return new.select("id", name.alias("name"), F.lit("route").alias("kind"), "file_path"), new.select(F.col("id").alias("src"), F.col("handler").alias("dst"), F.lit("entry_to").alias("kind")).join(edges.select("src", "dst", "kind"), ["src", "dst", "kind"], "left_anti")


def resolve_entries(entries: DataFrame, asked: DataFrame) -> DataFrame:
    """The entry of each (query_id, file_path, symbol, entry_id): by id, path, file name or symbol, then rest, rpc, cli, job."""
    order = F.when(F.col("kind") == "rest", 0).when(F.col("kind") == "rpc", 1).when(F.col("kind") == "cli", 2).when(F.col("kind") == "job", 3).otherwise(9)
    file = lambda c: F.element_at(F.split(c, "/"), -1)
    e = entries.select(F.col("id").alias("e_id"), "kind", F.col("file").alias("e_file"), F.col("symbol").alias("e_symbol"), order.alias("order"))
    tiers = [F.col("entry_id") == F.col("e_id"), F.col("file_path") == F.col("e_file"), file(F.col("file_path")) == file(F.col("e_file")), F.col("symbol") == F.col("e_symbol")]
    found = None
    for i, on in enumerate(tiers):
        one = asked.join(e, on).select("query_id", F.struct(F.lit(i).alias("tier"), "order", "e_id").alias("b"))
        found = one if found is None else found.unionByName(one)
    return found.groupBy("query_id").agg(F.min("b").alias("b")).select("query_id", F.col("b.e_id").alias("entry"))


def enrich(atoms: DataFrame, nodes: DataFrame, edges: DataFrame, most: int = 6) -> DataFrame:
    """(atom_id, ref, node, edge_path): code references met by node id, else by the name after '#'; edge_path are the node's first callees."""
    refs = atoms.select("atom_id", F.explode("source_refs").alias("r")).where("r.type = 'code'").select("atom_id", F.col("r.id").alias("ref")).distinct()
    by_id = refs.join(nodes.select(F.col("id").alias("ref")), "ref").withColumn("node", F.col("ref"))
    rest = refs.join(by_id.select("ref").distinct(), "ref", "left_anti").withColumn("name", F.element_at(F.split("ref", "#"), -1))
    by_name = rest.join(nodes.groupBy("name").agg(F.min("id").alias("node")), "name").drop("name")
    met = by_id.unionByName(by_name)
    ahead = G.neighbours(edges).join(met.select(F.col("node").alias("src")).distinct(), "src", "left_semi")
    n = F.row_number().over(Window.partitionBy("src").orderBy("dst"))
    path = ahead.withColumn("n", n).where(F.col("n") <= most).groupBy(F.col("src").alias("node")).agg(F.array_sort(F.collect_list("dst")).alias("edge_path"))
    return met.join(path, "node", "left").withColumn("edge_path", F.coalesce("edge_path", F.array().cast("array<string>")))


def ref_candidates(path: Column, prefixes) -> Column:
    """Where a reference's file may lie: as given, below each prefix, and by its bare name."""
    tidy = F.regexp_replace(F.translate(path, "\\", "/"), r"^\./", "")
    return F.array_distinct(F.concat(F.array(tidy), *[F.array(F.concat(F.lit(p.rstrip("/") + "/"), tidy)) for p in prefixes], F.array(F.element_at(F.split(tidy, "/"), -1))))


def normalise_refs(refs: DataFrame, files: DataFrame, prefixes=("src/main/java", "src/test/java")) -> DataFrame:
    """(ref, path): the first candidate of each reference's path that a file has or ends with, in the order of candidates; the path itself if none."""
    one = refs.select("ref", T.context_ref(F.col("ref"))["path"].alias("own")).distinct()
    tried = one.select("ref", "own", F.posexplode(ref_candidates(F.col("own"), prefixes)).alias("i", "try"))
    known = files.select("path").distinct()
    # A file is met by every ending of its path.
    parts = F.split("path", "/")
    endings = known.select("path", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "/"))).alias("try"))
    best = tried.join(endings, "try").groupBy("ref").agg(F.min(F.struct("i", "path")).alias("b"))
    return one.join(best, "ref", "left").select("ref", F.coalesce("b.path", "own").alias("path"), F.col("b").isNotNull().alias("found"))


def ref_rates(outcomes: DataFrame) -> DataFrame:
    """One row of counts and rates of the outcomes of references."""
    hit = lambda *k: F.count_if(F.col("outcome").isin(*k))
    rate = lambda n: F.bround(n / F.greatest(F.count("*"), F.lit(1)), 3)
    return outcomes.agg(F.count("*").alias("refs"), hit("symbol_hit").alias("symbol_hits"), hit("file_hit").alias("file_hits"), hit("miss").alias("misses"), rate(hit("symbol_hit", "file_hit")).alias("resolve_rate"), rate(hit("symbol_hit")).alias("exact_rate"))


def find_in_repositories(nodes: DataFrame, wanted: DataFrame, exact: bool = True) -> DataFrame:
    """(query_id, repo, id, name) of every repository's symbols of a name, or that hold it, whatever the case."""
    own = nodes.select("repo", "id", "name")
    if exact:
        return own.join(wanted.select("query_id", F.col("symbol").alias("name")), "name").select("query_id", "repo", "id", "name")
    met = contained(own.withColumn("_low", F.lower("name")), "_low", wanted.select("query_id", F.lower("symbol").alias("_wanted")), "_wanted")
    return met.select("query_id", "repo", "id", "name")


def fresh(nodes: DataFrame) -> bool:
    """Whether a graph holds anything yet."""
    return not nodes.isEmpty()
