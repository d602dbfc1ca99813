"""Assets of two splits: inventory, reservation, conflicts, duplicates, id resolution, and the accounts that must close."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import audio_id
from ..functions.parsing import path_fault, portable_name, positive_decimal
from .terms import total


def members(rows: DataFrame, asset: str, index: str, number: str, meta: list[str]) -> DataFrame:
    """One row an asset: its rows, distinct valid numbers, whether one is invalid, whether a metadata field differs, and its
    row with the smallest index. Rows without an asset id are none's."""
    value = positive_decimal(number)
    told = [F.countDistinct(F.coalesce(F.col(m).cast("string"), F.lit(""))) > 1 for m in meta]
    differs = reduce(lambda a, b: a | b, told, F.lit(False))
    return rows.where(F.col(asset).isNotNull()).groupBy(F.col(asset).alias("asset")).agg(F.count("*").alias("n"), F.countDistinct(value).alias("n_numbers"), F.max(value.isNull()).alias("invalid"), differs.alias("differs"), F.min(index).alias("first_row"))


def inventory(train: DataFrame, val: DataFrame, reserved: DataFrame) -> DataFrame:
    """Assets of either split (frames of ``members``) with their terminal class: of the other split, reserved (a frame of
    assets), in conflict with itself, or clean."""
    v = val.select("asset", F.col("n").alias("n_val"))
    r = reserved.select("asset").distinct().withColumn("reserved", F.lit(True))
    met = train.withColumnRenamed("n", "n_train").join(v, "asset", "full_outer").join(r, "asset", "left")
    met = met.select("asset", F.coalesce("n_train", F.lit(0)).alias("n_train"), F.coalesce("n_val", F.lit(0)).alias("n_val"), F.coalesce("reserved", F.lit(False)).alias("reserved"), "n_numbers", "invalid", "differs", "first_row")
    conflict = (F.col("n_train") > 0) & F.coalesce(F.col("invalid") | (F.col("n_numbers") > 1), F.lit(False))
    status = F.when(F.col("n_val") > 0, "VAL_RESERVED").when(F.col("reserved"), "RESERVED").when(conflict, "CONFLICT").otherwise("CLEAN")
    doubtful = (F.col("n_val") == 0) & (F.col("n_train") > 1) & F.coalesce(F.col("differs"), F.lit(False))
    return met.select("asset", "n_train", "n_val", "reserved", conflict.alias("conflict"), doubtful.alias("metadata_differs"), status.alias("status"), F.when(F.col("n_train") > 0, F.col("first_row")).alias("first_row"))


def clean_assets(inv: DataFrame) -> DataFrame:
    """Training assets that nothing excludes."""
    return inv.where("status = 'CLEAN' and n_train > 0").select("asset", "first_row")


def dispositions(rows: DataFrame, inv: DataFrame, asset: str, index: str) -> DataFrame:
    """row, asset, disposition of every training row with an asset: kept, collapsed into the first row, or why it is out."""
    why = F.when(F.col("status") == "CLEAN", F.when(F.col(index) == F.col("first_row"), "KEPT_CANONICAL").otherwise("COLLAPSED_DUPLICATE")).otherwise(F.concat(F.lit("EXCLUDED_"), F.col("status")))
    return rows.where(F.col(asset).isNotNull()).select(F.col(index), F.col(asset).alias("asset")).join(inv.select("asset", "status", "first_row"), "asset").select(F.col(index).alias("row"), "asset", why.alias("disposition"))


def sanitation(inv: DataFrame) -> DataFrame:
    """One row of accounts over an inventory: assets and training rows by what became of them."""
    only = (F.col("n_train") > 0) & (F.col("n_val") == 0)
    rows = lambda x, name, n=F.col("n_train"): F.coalesce(F.sum(F.when(x, n)), F.lit(0)).cast("long").alias(name)
    c, res = F.col("conflict"), F.col("reserved")
    return inv.agg(
        F.count("*").alias("assets"), total(F.col("n_train") > 0, "train_assets"), total(F.col("n_val") > 0, "val_assets"), total((F.col("n_train") > 0) & (F.col("n_val") > 0), "both"),
        total(only, "train_only"), total(only & (F.col("n_train") == 1), "single"), total(only & c, "conflicting"), total(only & ~c & (F.col("n_train") > 1), "consistent_repeats"),
        rows((F.col("n_train") > 0) & (F.col("n_val") > 0), "rows_other_split"), rows(only & c, "rows_conflict"), rows(only & ~c, "rows_collapsed", F.col("n_train") - 1), rows(only & res, "rows_reserved"),
        total(only & ~c, "clean_before_reserved"), total(F.col("status").eqNullSafe("CLEAN") & (F.col("n_train") > 0), "clean"),
    )


def sanitation_again(train: DataFrame, val: DataFrame, reserved: DataFrame, asset: str, number: str) -> DataFrame:
    """The clean training assets from set operations alone, to check ``clean_assets``."""
    ids = lambda d: d.where(F.col(asset).isNotNull()).select(F.col(asset).alias("asset")).distinct()
    bad = train.where(positive_decimal(number).isNull()).select(F.col(asset).alias("asset"))
    several = train.select(F.col(asset).alias("asset"), positive_decimal(number).alias("v")).distinct().groupBy("asset").agg(F.count("*").alias("k")).where("k > 1").select("asset")
    return ids(train).subtract(ids(val)).subtract(reserved.select("asset").distinct()).subtract(bad.unionAll(several).distinct())


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of exactly one of two sets, and of which."""
    return a.subtract(b).withColumn("of", F.lit("left")).unionAll(b.subtract(a).withColumn("of", F.lit("right")))


def set_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """key and whether it was added, removed or stays."""
    a, b = old.select(key).distinct().withColumn("_o", F.lit(1)), new.select(key).distinct().withColumn("_n", F.lit(1))
    return a.join(b, key, "full_outer").select(key, F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").otherwise("unchanged").alias("change"))


def changed(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """Keys whose value differs between two snapshots, or that only one has."""
    a, b = before.select(key, F.col(value).alias("_a")), after.select(key, F.col(value).alias("_b"))
    return a.join(b, key, "full_outer").where(~F.col("_a").eqNullSafe(F.col("_b"))).select(key)


def reserved_by_task(rows: DataFrame, asset: str, task: str) -> DataFrame:
    """Per sub-task: its rows with an asset id, and distinct ids."""
    return rows.groupBy(F.coalesce(F.col(task).cast("string"), F.lit("None")).alias("task")).agg(F.count("*").alias("n"), F.countDistinct(asset).alias("n_assets"))


def resolve(asks: DataFrame, rows: DataFrame, asset: str, number: str) -> DataFrame:
    """The asking rows with how their asset is known: usable (all its rows have one valid number), ambiguous, not found."""
    v = positive_decimal(number)
    index = rows.where(F.col(asset).isNotNull()).groupBy(F.col(asset).alias("asset")).agg(F.countDistinct(v).alias("k"), F.max(v.isNull()).alias("bad"), F.max(v).alias("number"))
    kind = F.when(F.col("k").isNull(), "not_found").when((F.col("k") == 1) & ~F.col("bad"), "usable").otherwise("ambiguous")
    return asks.join(index, "asset", "left").select(asks["*"], kind.alias("resolution"), F.when(kind == "usable", F.col("number")).alias("number"))


def duplicate_decisions(rows: DataFrame, index: str, content: str, label: str) -> DataFrame:
    """row, decision of the rows whose content occurs again: with one label the smallest row is kept, with several all go."""
    per = rows.where(F.col(content).isNotNull()).groupBy(content).agg(F.count("*").alias("n"), F.min(F.struct(F.col(label))).alias("a"), F.max(F.struct(F.col(label))).alias("z"), F.min(index).alias("first")).where("n > 1")
    what = F.when(~F.col("a").eqNullSafe(F.col("z")), "CONFLICTING_EXCLUDE").when(F.col(index) == F.col("first"), "KEEP").otherwise("SAME_LABEL_EXCLUDE")
    return rows.join(per, content).select(F.col(index).alias("row"), what.alias("decision"))


def eligible(rows: DataFrame, index: str, label: str, codes: dict[str, str], payload: str, excluded: DataFrame) -> DataFrame:
    """row, gold: rows whose label has a meaning, whose payload isn't empty and that ``excluded`` (row) does not name."""
    from ..functions.parsing import blank, recoded

    gold = recoded(label, codes)
    good = rows.where(gold.isNotNull() & ~blank(payload)).select(F.col(index).alias("row"), gold.alias("gold"))
    return good.join(excluded.select("row").distinct(), "row", "left_anti")


def without_conflicts(rows: DataFrame, speaker: str, value: Column) -> DataFrame:
    """Rows of named speakers for whom the value, where it is known, is one and the same; rows without a value go."""
    held = rows.withColumn("_v", value).where("_v is not null").where(F.col(speaker).isNotNull() & (F.col(speaker).cast("string") != ""))
    bad = held.groupBy(speaker).agg((F.min("_v") != F.max("_v")).alias("bad")).where("bad").select(speaker)
    return held.join(bad, speaker, "left_anti").drop("_v")


def metadata_disagreement(rows: DataFrame, group: str, fields: list[str]) -> DataFrame:
    """Groups and whether any of the fields differs inside; null is a value like others."""
    differs = [F.countDistinct(F.coalesce(F.col(f).cast("string"), F.lit(""))) > 1 for f in fields]
    return rows.groupBy(group).agg(reduce(lambda a, b: a | b, differs).alias("differs"))


def anomalies(records: DataFrame, rows: DataFrame | None = None, noise: float = 0.02, least: int = 5, dominant: float = 0.5) -> DataFrame:
    """Per task whether its anomalies (row_id, task_id, signature) are a systematic pattern, local noise or undecided.

    One coherent signature that makes up half of at least ``least`` anomalies is a pattern however few rows it hits; HETEROGENEOUS
    never is. Otherwise at most ``noise`` of the rows is noise. ``rows``: (task_id, n) rows a task has; without it, those that
    occur in the records.
    """
    r = records.withColumn("signature", F.coalesce("signature", F.lit("HETEROGENEOUS")))
    per = r.groupBy("task_id", "signature").agg(F.count("*").alias("c"))
    # of signatures that occur equally often, one that is coherent counts
    top = F.max(F.struct(F.col("c"), (F.col("signature") != "HETEROGENEOUS").alias("coherent"), F.col("signature")))
    task = per.groupBy("task_id").agg(F.sum("c").alias("n"), top.alias("top"))
    size = r.groupBy("task_id").agg(F.countDistinct("row_id").alias("rows")) if rows is None else rows.select("task_id", F.col("n").alias("rows"))
    share, part = F.col("top.c") / F.col("n"), F.when(F.col("rows") > 0, F.col("n") / F.col("rows")).otherwise(F.lit(0.0))
    kind = F.when(F.col("top.coherent") & (share >= dominant) & (F.col("n") >= least), "SYSTEMATIC_CONTRACT_PATTERN").when(part <= noise, "LOCAL_HETEROGENEOUS_NOISE").otherwise("UNRESOLVED")
    severity = F.when(kind == "SYSTEMATIC_CONTRACT_PATTERN", "BLOCKING").when(kind == "LOCAL_HETEROGENEOUS_NOISE", "AUTO_DROP_ROW").otherwise("REVIEW")
    return task.join(size, "task_id").select("task_id", "n", F.round(part, 6).alias("fraction"), kind.alias("kind"), severity.alias("severity"), F.when(kind == "SYSTEMATIC_CONTRACT_PATTERN", F.col("top.signature")).alias("dominant"))


def task_eligibility(records: DataFrame, verdicts: DataFrame) -> DataFrame:
    """row_id, task_id, status, reason: a systematic task is blocked for its anomalous rows, else they are dropped."""
    blocked = F.col("kind") == "SYSTEMATIC_CONTRACT_PATTERN"
    met = records.select("row_id", "task_id").distinct().join(verdicts, "task_id")
    return met.select("row_id", "task_id", F.when(blocked, "BLOCKED_BY_CONTRACT").otherwise("DROP_LOCAL_ANOMALY").alias("status"), F.when(blocked, F.col("dominant")).otherwise("local_anomaly").alias("reason"))


def audio_index(rows: DataFrame, identity: str, path: str) -> DataFrame:
    """identity, name, fault: the portable name of each row's file; why there is none, or that ids or names are not one to one."""
    faults = F.when(F.coalesce(F.trim(F.col(identity).cast("string")) == "", F.lit(True)), "MISSING_IDENTITY").otherwise(path_fault(path))
    named = rows.select(F.col(identity).cast("string").alias("identity"), portable_name(path).alias("name"), faults.alias("fault"))
    per_id = named.groupBy("identity").agg(F.count("*").alias("n"), F.min("name").alias("name"), F.min("fault").alias("fault"))
    owners = per_id.where("fault is null").groupBy("name").agg(F.count("*").alias("k")).where("k > 1")
    met = per_id.join(owners, "name", "left")
    return met.select("identity", "name", F.coalesce("fault", F.when(F.col("n") > 1, "AMBIGUOUS_IDENTITY"), F.when(F.col("k") > 1, "BASENAME_COLLISION")).alias("fault"))


def resolve_audio(records: DataFrame, index: DataFrame, dataset: str, revision: str) -> DataFrame:
    """id, position, audio_id, name, fault of every audio of records (id, audio_ids, row_ids), in order: the id must be that
    of its row, and the row must have a portable name."""
    pos = F.posexplode(F.arrays_zip("audio_ids", "row_ids")).alias("position", "e")
    each = records.withColumn("arity", F.size("audio_ids") == F.size("row_ids")).select("id", "arity", pos).select("id", "arity", "position", F.col("e.audio_ids").alias("audio_id"), F.col("e.row_ids").cast("string").alias("row_id"))
    linked = each.withColumn("link", audio_id(dataset, revision, "row_id").eqNullSafe(F.col("audio_id")))
    met = linked.join(index.select(F.col("identity").alias("row_id"), "name", F.col("fault").alias("why")), "row_id", "left")
    fault = F.when(~F.col("arity"), "AUDIO_ROW_ARITY_MISMATCH").when(~F.col("link"), "AUDIO_ID_LINK_MISMATCH").when(F.col("name").isNull() | F.col("why").isNotNull(), F.coalesce("why", F.lit("UNRESOLVED_IDENTITY")))
    return met.select("id", F.col("position").cast("int").alias("position"), "audio_id", F.when(fault.isNull(), F.col("name")).alias("name"), fault.alias("fault"))


def model_matches_internal(model: DataFrame, internal: DataFrame) -> DataFrame:
    """id, fault of model records (id, audio) against internal ones (id, audio_ids): missing, or audio in other order."""
    met = model.select("id", "audio").join(internal.select("id", "audio_ids"), "id", "left")
    return met.select("id", F.when(F.col("audio_ids").isNull(), "MODEL_RECORD_WITHOUT_INTERNAL").when(~F.col("audio").eqNullSafe(F.col("audio_ids")), "MODEL_INTERNAL_AUDIO_MISMATCH").alias("fault"))


def logical_mapping(records: DataFrame) -> DataFrame:
    """audio_id, row_id, ambiguous: which row each logical audio stands for, from records (audio_ids, row_ids)."""
    each = records.select(F.explode(F.arrays_zip("audio_ids", "row_ids")).alias("e")).select("e.audio_ids", F.col("e.row_ids").cast("string").alias("row_id"))
    return each.groupBy(F.col("audio_ids").alias("audio_id")).agg(F.min("row_id").alias("row_id"), (F.countDistinct("row_id") > 1).alias("ambiguous"))


def physical_mapping(records: DataFrame, singles: DataFrame, pairs: DataFrame) -> DataFrame:
    """id, path, fault: records of one audio meet the files of rows (row_id, path), those of two the composites (a, b, path)."""
    n = F.size("row_ids")
    row = lambda i: F.get(F.col("row_ids"), F.lit(i)).cast("string")
    asks = records.select("id", n.alias("n"), row(0).alias("a"), row(1).alias("b"))
    one = asks.join(singles.select(F.col("row_id").cast("string").alias("a"), F.col("path").alias("p1")), "a", "left")
    both = one.join(pairs.select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"), F.col("path").alias("p2")), ["a", "b"], "left")
    path = F.when(F.col("n") == 1, F.col("p1")).when(F.col("n") == 2, F.col("p2"))
    return both.select("id", path.alias("path"), F.when(~F.col("n").isin(1, 2), "ARITY").when(path.isNull(), "UNRESOLVED").alias("fault"))


def availability(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """One row: planned files, those at hand, those missing."""
    met = manifest.select("path").distinct().join(files.select("path").distinct().withColumn("here", F.lit(1)), "path", "left")
    return met.agg(F.count("*").alias("planned"), total(F.col("here").isNotNull(), "at_hand"), total(F.col("here").isNull(), "missing"))


def first_by_signature(rows: DataFrame, signature: str, order: str, approved: DataFrame) -> DataFrame:
    """row, outcome: a signature that was approved before makes its rows duplicates; else its first row is accepted."""
    known = approved.select(F.col(signature).alias("_sig")).distinct()
    first = rows.groupBy(signature).agg(F.min(order).alias("_first")).withColumnRenamed(signature, "_s2")
    met = rows.join(known, rows[signature].eqNullSafe(known["_sig"]), "left").join(first, rows[signature].eqNullSafe(first["_s2"]))
    outcome = F.when(F.col("_sig").isNotNull(), "DUPLICATE_OF_APPROVED").when(F.col(order) == F.col("_first"), "ACCEPTED").otherwise("DUPLICATE_IN_ROUND")
    return met.select(F.col(order).alias("row"), F.col(signature), outcome.alias("outcome"))


def partition_faults(everything: DataFrame, parts: dict[str, DataFrame], key: str) -> DataFrame:
    """One row: keys of two parts, of no part, and of a part but not of the whole; all 0 in a partition."""
    each = reduce(DataFrame.unionAll, [d.select(F.col(key).alias("k")).distinct().withColumn("p", F.lit(n)) for n, d in sorted(parts.items())])
    met = each.groupBy("k").agg(F.count("*").alias("c")).join(everything.select(F.col(key).alias("k")).distinct().withColumn("whole", F.lit(1)), "k", "full_outer")
    return met.agg(total(F.col("c") > 1, "overlap"), total(F.col("c").isNull(), "missing"), total(F.col("whole").isNull(), "extra"))


def overlap_report(train: DataFrame, val: DataFrame, file: str, speaker: str, province: str) -> DataFrame:
    """One row: sizes, distinct provinces and speakers, files and speakers in both, provinces in one only, repeated files."""
    both = train.select(F.lit(0).alias("v"), file, speaker, province).unionAll(val.select(F.lit(1).alias("v"), file, speaker, province))
    side = lambda c: both.where(F.col(c).isNotNull()).groupBy(c).agg(F.min("v").alias("a"), F.max("v").alias("z"))
    shared = lambda c, name: side(c).agg(total(F.col("a") != F.col("z"), name))
    sizes = both.agg(total(F.col("v") == 0, "n_train"), total(F.col("v") == 1, "n_val"), *[F.countDistinct(F.when(F.col("v") == v, F.col(c))).alias(f"{n}_{'val' if v else 'train'}") for v in (0, 1) for n, c in (("speakers", speaker), ("provinces", province), ("files", file))])
    odd = side(province).agg(total(F.col("a") == F.col("z"), "odd_provinces"))
    return sizes.join(F.broadcast(shared(file, "file_overlap"))).join(F.broadcast(shared(speaker, "speaker_overlap"))).join(F.broadcast(odd))


def sample_stats(rows: DataFrame, group: str, speaker: str, text: str) -> DataFrame:
    """One row: rows, groups, speakers, speakers of several rows, least, most and mean text length."""
    n = F.length(F.coalesce(F.col(text), F.lit("")))
    whole = rows.agg(F.count("*").alias("n"), F.countDistinct(group).alias("n_groups"), F.countDistinct(speaker).alias("n_speakers"), F.min(n).alias("least"), F.max(n).alias("most"), F.round(F.avg(n), 1).alias("mean"))
    again = rows.where(F.col(speaker).isNotNull()).groupBy(speaker).agg(F.count("*").alias("c")).agg(total(F.col("c") > 1, "repeated_speakers"))
    return whole.join(F.broadcast(again))


def source_inventory(rows: DataFrame, identity: str, fields: list[str], groups: list[str]) -> DataFrame:
    """kind, name, n: rows, distinct identities, rows where each field is present, distinct groups; one pass."""
    present = lambda c: F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")
    facts = [("rows", "", F.count("*")), ("identities", identity, F.countDistinct(identity)), ("unique", identity, (F.countDistinct(identity) == F.count("*")).cast("long"))]
    facts += [("eligible", f, F.coalesce(F.sum(present(f).cast("long")), F.lit(0).cast("long"))) for f in fields] + [("groups", g, F.countDistinct(F.when(present(g), F.col(g)))) for g in groups]
    told = rows.agg(*[x.cast("long").alias(f"x{i}") for i, (_, _, x) in enumerate(facts)])
    return told.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(n).alias("name"), F.col(f"x{i}").alias("n")) for i, (k, n, _) in enumerate(facts)])).alias("e")).select("e.*")


def field_equality(rows: DataFrame, a: str, b: str) -> DataFrame:
    """One row: rows where both fields are known, and the share where their texts are equal."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    same = F.col(a).cast("string") == F.col(b).cast("string")
    n = F.coalesce(F.sum(both.cast("long")), F.lit(0).cast("long"))
    return rows.agg(n.alias("n"), F.round(F.coalesce(F.sum((both & same).cast("long")) / F.nullif(n, F.lit(0).cast("long")), F.lit(0.0)), 6).alias("rate"))


def first_values(rows: DataFrame, fields: list[str], order: str, k: int) -> DataFrame:
    """field, n, value: the k values of each field that occur first in the order."""
    each = rows.select(F.col(order).alias("_o"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("e")).select("_o", "e.*").where("value is not null")
    first = each.groupBy("field", "value").agg(F.min("_o").alias("_o"))
    n = F.row_number().over(Window.partitionBy("field").orderBy("_o", "value"))
    return first.withColumn("n", n).where(F.col("n") <= k).select("field", "n", "value")
