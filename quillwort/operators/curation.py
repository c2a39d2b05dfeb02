"""Dedup, gates, validation, reconciliation and reports of the corpus build."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quillwort.functions.cards import ACKNOWLEDGED
from quillwort.functions.text import slug, stripped

# Format families, and formats from the preferred one on.
FAMILY = {"doc": "word", "docx": "word", "docm": "word", "rtf": "word", "ppt": "ppt", "pptx": "ppt", "xls": "xls", "xlsx": "xls"}
PREFERRED = ["docx", "docm", "doc", "rtf", "pptx", "ppt", "xlsx", "xls"]
# Fixed value: requests that carry no knowledge.
NOISE = r"(?i)\b(password reset|reset my password|access request|grant (me )?access|please rerun|re-?run the job|kindly rerun|unlock (my )?account|add (me|user) to|new user request)\b"
LEAST_THREAD = 120


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """SHA-256 groups of over one row: how many rows, the first id and the last; partial aggregates, no ids are gathered."""
    hashed = docs.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    return hashed.groupBy("sha").agg(F.count("*").alias("n"), F.min("doc_id").alias("keep"), F.max("doc_id").alias("last")).where("n > 1")


def ticket_verdicts(tickets: DataFrame) -> DataFrame:
    """duplicate, noise-pattern, thin-content, no-diagnosis or keep; only an earlier *kept* ticket makes a duplicate.

    ``n_agent`` counts the agents' replies that say more than an acknowledgement (``substantial_replies``).  The first kept
    ticket of a hash is found by partial aggregates and joined back, so no hash's tickets need to meet in one task.
    """
    part = lambda c: F.coalesce(F.lower(stripped(c)), F.lit(""))
    h = F.sha2(F.concat_ws("|", F.coalesce("client", F.lit("")), part("subject"), part("description")), 256)
    alone = F.when(F.concat_ws(" ", "subject", "description").rlike(NOISE), "noise-pattern").when(F.col("thread_chars") < LEAST_THREAD, "thin-content").when(F.col("n_agent") == 0, "no-diagnosis").otherwise("keep")
    rows = tickets.select("ticket_id", h.alias("h"), alone.alias("alone"))
    first_kept = rows.where("alone = 'keep'").groupBy("h").agg(F.min("ticket_id").alias("first_kept"))
    return rows.join(first_kept, "h", "left").select("ticket_id", F.when(F.col("ticket_id") > F.col("first_kept"), "duplicate").otherwise(F.col("alone")).alias("verdict"))


def substantial_replies(comments: DataFrame) -> DataFrame:
    """comments(ticket_id, role, body): how many of a ticket's agent replies are neither blank nor a mere acknowledgement."""
    solid = (F.col("role") == "assistant") & (stripped("body") != "") & ~stripped("body").rlike(ACKNOWLEDGED)
    return comments.groupBy("ticket_id").agg(F.count_if(solid).alias("n_solid"))


def format_variants(plan: DataFrame) -> DataFrame:
    """plan(pos, stem, ext): keeps the preferred format of each (stem, family); unknown formats are families of their own."""
    fam = F.create_map(*[F.lit(x) for kv in FAMILY.items() for x in kv])
    rows = plan.withColumn("family", F.coalesce(fam[F.col("ext")], F.col("ext"))).withColumn("rank", F.array_position(F.array(*map(F.lit, PREFERRED)), F.col("ext")))
    rows = rows.withColumn("rank", F.when(F.col("rank") == 0, 99).otherwise(F.col("rank")))
    w = W.partitionBy("stem", "family").orderBy("rank", "pos")
    return rows.select("pos", "stem", "ext", "family", (F.row_number().over(w) == 1).alias("kept"), F.first("pos").over(w).alias("kept_pos"))


def assign_slugs(rows: DataFrame) -> DataFrame:
    """rows(pos, product, name): the nth row of a base slug gets -n."""
    base = rows.withColumn("base", F.concat_ws("-", slug("product"), slug("name")))
    n = F.row_number().over(W.partitionBy("base").orderBy("pos"))
    return base.select("pos", F.when(n == 1, F.col("base")).otherwise(F.concat_ws("-", "base", n.cast("string"))).alias("slug"))


def newest(docs: DataFrame) -> DataFrame:
    """docs(base, version, path): the highest version string of each base, the first path on ties."""
    n = F.row_number().over(W.partitionBy("base").orderBy(F.desc("version"), "path"))
    return docs.withColumn("n", n).where("n = 1").drop("n")


def corpus_gauges(cards: DataFrame) -> DataFrame:
    return cards.groupBy("product", F.coalesce("regime", F.lit("none")).alias("regime")).agg(F.count("*").alias("n"))


def corrections_by_target(cards: DataFrame) -> DataFrame:
    """Approved corrections of each card in index order."""
    ok = cards.where("type = 'correction' and status = 'approved'").groupBy("corrects").agg(F.sort_array(F.collect_list(F.struct("ord", "card_id"))).alias("c"))
    return ok.select("corrects", F.array_join("c.card_id", ",").alias("corrections"), F.size("c").cast("long").alias("n"))


def cross_facet_edges(cards: DataFrame, edges: DataFrame, facet: str = "regime") -> DataFrame:
    a = cards.select(F.col("card_id").alias("src"), F.col(facet).alias("a"))
    b = cards.select(F.col("card_id").alias("dst"), F.col(facet).alias("b"))
    return edges.join(a, "src").join(b, "dst").where("a <> b").select("src", "dst", "a", "b")


def dangling_edges(cards: DataFrame, edges: DataFrame) -> DataFrame:
    return edges.join(cards.select(F.col("card_id").alias("dst")), "dst", "left_anti").select("src", "dst", "pos")


def correction_findings(cards: DataFrame, supersedes: DataFrame) -> DataFrame:
    """Lint of corrections: target missing or itself a correction, unknown supersedes, superseded but approved, several live.

    supersedes(card_id, old) has what each correction supersedes; a correction superseded by an approved one is not live.
    """
    c = cards.where("type = 'correction'").select("card_id", "corrects", "status")
    target = cards.where("type <> 'correction'").select(F.col("card_id").alias("corrects"))
    dangling = c.join(target, "corrects", "left_anti").select("card_id", F.lit("dangling").alias("finding"))
    ours = supersedes.join(c.select("card_id", "status"), "card_id")
    unknown = ours.join(c.select(F.col("card_id").alias("old")), "old", "left_anti").select("card_id", F.lit("supersedes unknown").alias("finding")).distinct()
    gone = ours.where("status = 'approved'").select(F.col("old").alias("card_id")).distinct()
    approved = c.where("status = 'approved'")
    still = approved.join(gone, "card_id", "left_semi").select("card_id", F.lit("superseded but approved").alias("finding"))
    live = approved.join(gone, "card_id", "left_anti").join(cards.select(F.col("card_id").alias("corrects")), "corrects", "left_semi")
    many = live.groupBy("corrects").agg(F.count("*").alias("n"), F.min("card_id").alias("card_id")).where("n > 1").select("card_id", F.lit("several live").alias("finding"))
    return dangling.unionByName(unknown).unionByName(still).unionByName(many)


def memory_findings(memories: DataFrame, related: DataFrame, supersedes: DataFrame, concepts: DataFrame, products: list[str]) -> DataFrame:
    """Lint of memories(card_id, product, client, status): bad product, dangling related, supersedes unknown or across clients, superseded but approved."""
    m = memories.select("card_id", "product", "client", "status")
    bad = m.where(~F.coalesce(F.col("product").isin(products), F.lit(False))).select("card_id", F.lit("bad product").alias("finding"))
    dangling = related.join(m.select("card_id"), "card_id", "left_semi").join(concepts.select(F.col("card_id").alias("dst")), "dst", "left_anti").select("card_id", F.lit("dangling related").alias("finding"))
    old = m.select(F.col("card_id").alias("old"), F.col("client").alias("old_client"), F.col("status").alias("old_status"), F.lit(True).alias("known"))
    pairs = supersedes.join(m, "card_id").join(old, "old", "left")
    same = F.col("client").eqNullSafe(F.col("old_client"))
    unknown = pairs.where("known is null").select("card_id", F.lit("supersedes unknown").alias("finding"))
    across = pairs.where(F.col("known").isNotNull() & ~same).select("card_id", F.lit("supersedes across clients").alias("finding"))
    still = pairs.where(F.col("known") & same & (F.col("status") == "approved") & (F.col("old_status") == "approved")).select(F.col("old").alias("card_id"), F.lit("superseded but approved").alias("finding")).distinct()
    return bad.unionByName(dangling).unionByName(unknown).unionByName(across).unionByName(still)


def live_memories(memories: DataFrame, supersedes: DataFrame) -> DataFrame:
    """Approved memories(card_id, client, status) that no approved memory of the same client supersedes(card_id, old)."""
    side = memories.select("card_id", "client", "status")
    new, old = side.where("status = 'approved'").drop("status"), side.select(F.col("card_id").alias("old"), F.col("client").alias("old_client"))
    gone = supersedes.select("card_id", "old").join(new, "card_id").join(old, "old").where(F.col("client").eqNullSafe(F.col("old_client"))).select(F.col("old").alias("card_id")).distinct()
    return memories.where("status = 'approved'").join(gone, "card_id", "left_anti")


def conflict_candidates(live: DataFrame, marks: DataFrame, block: int = 1000) -> DataFrame:
    """client, a and b (a < b): the pairs of live(card_id, client) memories of one client, null included, that share a mark of marks(card_id, mark).

    Marks are tags and related cards.  A pair meets at each mark it shares and is made at one only, the rarest by count, so
    no pair is made twice and none needs a distinct.  The memories of a (client, mark) are cut into blocks of about ``block``; two
    blocks meet in a task of their own, so a mark of a third of all memories is spread over many.
    """
    held = marks.where("mark is not null").select("card_id", "mark").distinct().join(live.select("card_id", "client"), "card_id")
    size = held.groupBy(F.col("client").alias("its_client"), F.col("mark").alias("its_mark")).agg(F.count("*").alias("n")).where("n > 1")
    sized = held.join(size, (F.col("mark") == F.col("its_mark")) & F.col("client").eqNullSafe(F.col("its_client"))).select("card_id", "client", "mark", "n")
    sets = sized.groupBy("card_id").agg(F.array_sort(F.collect_list(F.struct("n", "mark"))).alias("set"))
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("card_id"), blocks).cast("int")
    rows = sized.join(sets, "card_id").select("client", "mark", "card_id", "set", "n", own.alias("own"), blocks.alias("blocks"))
    met = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "client", "mark", "card_id", "set", "n", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    )
    a, b = (met.select(*[F.col(c).alias(f"{c}_{k}") for c in met.columns]) for k in "ab")
    key = [F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_b")) for c in ("client", "mark", "i", "j")]
    # In the task of blocks (i, j) a row of i meets a row of j; in that of (i, i) all meet.
    pairs = a.join(b, key).where("card_id_a <> card_id_b and (i_a = j_a or (own_a = i_a and own_b = j_a))").where((F.col("i_a") < F.col("j_a")) | (F.col("card_id_a") < F.col("card_id_b")))
    once = F.get(F.array_intersect("set_a", "set_b"), 0) == F.struct(F.col("n_a").alias("n"), F.col("mark_a").alias("mark"))
    return pairs.where(once).select(F.col("client_a").alias("client"), F.least("card_id_a", "card_id_b").alias("a"), F.greatest("card_id_a", "card_id_b").alias("b"))


def cyclic_nodes(edges: DataFrame, checkpoint) -> DataFrame:
    """Nodes that reach a cycle along edges(src, dst).

    A round drops edges to nodes without an edge out, and edges to a node with just one go on to where that one leads: both leave
    it as it is whose ways end.  When none is dropped, no way ends.  Chains of any shape of tree thus take rounds by the logarithm
    of their length; a layer of nodes that all have several live edges still takes a round of its own.
    """
    live = checkpoint(edges.select("src", "dst"))
    n = live.count()
    while True:
        least, most = F.min("dst"), F.max("dst")
        out = live.groupBy("src").agg(F.when(least == most, least).alias("on")).withColumnRenamed("src", "dst")
        live = checkpoint(live.join(out, "dst").select("src", F.coalesce("on", "dst").alias("dst")))
        m = live.count()
        if m == n:
            return live.select(F.col("src").alias("node")).distinct()
        n = m


def reconcile_columns(left: DataFrame, right: DataFrame) -> DataFrame:
    """(tab, col, pos, type) of two dialects: the left is the authority, both types are kept."""
    r = right.select("tab", "col", F.col("pos").alias("rpos"), F.col("type").alias("type_db2"))
    return left.join(r, ["tab", "col"], "full_outer").select("tab", "col", F.coalesce("pos", F.col("rpos") + 1000).alias("pos"), F.col("type").alias("type_oracle"), "type_db2")


def package_units(units: DataFrame) -> DataFrame:
    """units(name, kind, module, body, ord): one package each; first module, last spec and last body."""
    is_body = F.col("kind") == "body"
    return units.groupBy("name").agg(F.min_by("module", "ord").alias("module"), F.max_by(F.when(~is_body, F.col("body")), F.when(~is_body, F.col("ord"))).alias("spec"), F.max_by(F.when(is_body, F.col("body")), F.when(is_body, F.col("ord"))).alias("body"))


def inventory_stats(files: DataFrame) -> DataFrame:
    return files.groupBy("ext").agg(F.count("*").alias("n"), F.sum(F.when(F.col("size") >= 0, F.col("size"))).alias("bytes"), F.count(F.when(F.col("size") < 0, 1)).alias("errors")).orderBy(F.desc("n"), "ext").limit(15)


def index_pages(cards: DataFrame) -> DataFrame:
    """Per product: count and the links, in order of card id."""
    g = cards.where("type <> 'correction'").groupBy("product").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("card_id", "title"))).alias("c"))
    return g.select("product", "n", F.sha2(F.array_join(F.transform("c", lambda x: F.concat(F.lit("- "), x["card_id"])), "\n"), 256).alias("page_sha"))
