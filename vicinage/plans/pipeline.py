"""The stages of a run as one lazy plan: records to candidates, windows, features, families, similarity and output."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vicinage.operators import enrich, families, similarity, taxonomy, trees, windows
from vicinage.plans.config import Settings
from vicinage.session import cut


@dataclass
class Result:
    records: DataFrame
    neighbourhoods: DataFrame
    gff: DataFrame
    proteins: DataFrame
    similarity: DataFrame
    tree: str | None = None
    tree_metadata: DataFrame | None = None


def neighbourhoods(records: DataFrame, features: DataFrame, settings: Settings) -> DataFrame:
    """Windows of the sound records: uid, seqid, start_win, end_win, start_target, end_target; windows that are too
    small are marked as failed."""
    sound = records.where("failed is null and nucleotide_id is not null")
    full = windows.fill_full_contigs(sound).withColumnRenamed("nucleotide_id", "seqid").where("start is not null and end is not null")
    if settings.win_mode == "win_nts":
        w = windows.windows_by_distance(full, settings.window)
    else:
        target = features.select("seqid", F.col("id").alias("target_id"), F.col("start").alias("start"), F.col("end").alias("end"))
        spans = windows.windows_by_rows(features, full.join(target, ["seqid", "start", "end"]).select("uid", "seqid", "target_id"), settings.window)
        w = full.join(spans.select("uid", "start_win", "end_win"), "uid")
    w = w.withColumnRenamed("start", "start_target").withColumnRenamed("end", "end_target")
    small = windows.too_small(settings.min_win_type, settings.min_win, F.col("is_full_contig"))
    return enrich.mark_failed(w, small, "window too small")


def run(records: DataFrame, features: DataFrame, proteins: DataFrame, hits: DataFrame, settings: Settings = Settings(), ranks: DataFrame | None = None, lineages: DataFrame | None = None, ani: DataFrame | None = None, newick: str | None = None) -> Result:
    """Everything but external tools. records as enrich.candidates takes them; features: (id, seqid, type, start, end,
    protein_id); proteins: (id, sequence); hits: (qseqid, sseqid, pident, evalue).

    The trees of three modes need a table of their own: taxonomy lineages (taxid, lineage), without which there is a
    warning and no tree; ani_tree ani (query, ref, ani) of windows or contigs; use_input_tree newick.
    """
    needed = {"ani_tree": ("ani", ani), "use_input_tree": ("newick", newick)}.get(settings.tree_mode)
    if needed and needed[1] is None:
        raise ValueError(f"tree_mode {settings.tree_mode} needs {needed[0]}")
    chosen = enrich.candidates(records, settings.cand_mode)
    hood = cut(neighbourhoods(chosen, features, settings), "hoods")
    kept = hood.where("failed is null")
    inside = windows.contained(features, kept.select("uid", "seqid", "start_win", "end_win"))
    members = families.numbered_families(cut(families.components(families.filtered_hits(hits, settings.max_evalue, settings.min_pident), "qseqid", "sseqid"), "members"))
    prot = inside.where("protein_id is not null").select("uid", "seqid", F.col("protein_id").alias("id")).distinct().join(members.select("id", F.col("family").alias("fam_cluster")), "id", "left").join(proteins.select("id", "sequence").dropDuplicates(["id"]), "id", "left")
    prot = cut(prot, "proteins")
    used = prot  # both target_region and window keep what lies in the windows, and prot has nothing else
    if settings.aai_subset_mode == "target_prot":
        targets = kept.select("uid", F.col("protein_id").alias("target_prot"))
        used = prot.join(similarity.subset_ids("target_prot", prot, targets).select("id").distinct(), "id", "left_semi")
    genome = used.select("id", F.col("uid").alias("genome")).distinct()
    if settings.aai_mode == "hyper":
        sim = similarity.shared_families(used.select(F.col("uid").alias("genome"), F.col("fam_cluster").alias("family")), settings.max_df_frac, settings.min_shared)
        pairs = sim.select("a", "b", (F.least(F.col("score") / 100, F.lit(1.0))).alias("identity"))
    else:
        rbh = similarity.reciprocal_best(similarity.annotate_hits(hits, genome))
        sim = similarity.repertoire_similarity(rbh, similarity.proteome_sizes(genome))
        pairs = sim.select(F.col("q_genome").alias("a"), F.col("s_genome").alias("b"), (F.col("wgrr") if settings.aai_mode == "wgrr" else F.col("aai") / 100).alias("identity"))
    result = Result(chosen, hood, inside, prot, sim)
    result.tree = _tree(settings, kept, inside, prot, pairs, lineages, ani, newick)
    if ranks is not None:
        result.tree_metadata = taxonomy.leaf_metadata(chosen.withColumnRenamed("uid", "unique_id"), ranks)
    return result


def _tree(settings: Settings, kept: DataFrame, inside: DataFrame, prot: DataFrame, pairs: DataFrame, lineages: DataFrame | None, ani: DataFrame | None, newick: str | None) -> str | None:
    """Newick text by tree_mode; its leaves are the neighbourhoods."""
    mode = settings.tree_mode
    if mode == "use_input_tree":
        return newick
    if mode == "taxonomy":
        if lineages is None:
            warnings.warn("tree_mode taxonomy without lineages: no tree", stacklevel=3)
            return None
        return taxonomy.taxonomy_tree(kept.select(F.col("uid").alias("id"), "taxid"), lineages)
    leaves = kept.select(F.col("uid").alias("id")).distinct()
    families_of = prot.where("fam_cluster is not null").select(F.col("uid").alias("id"), F.col("fam_cluster").alias("item"))
    fill = "max_std"
    if mode == "aai_tree":
        dist = trees.identity_distance(cut(pairs, "pairs"))
    elif mode == "ani_tree":
        exact = kept.select(F.concat_ws("_", "seqid", "start_win", "end_win").alias("temp_seqid"), "uid")
        owner = kept.select("seqid", "uid")
        owned = similarity.owned_by(similarity.owned_by(ani.where("ani is not null"), "query", exact, owner, "a"), "ref", exact, owner, "b")
        dist = trees.identity_distance(cut(owned.where("a is not null and b is not null").select("a", "b", F.col("ani").cast("double").alias("identity")), "pairs"))
    elif mode == "neighborhood_phylo":
        fill = "one"  # the cosine distance of what shares nothing
        target = kept.select("uid", F.col("protein_id").alias("_target"), "start_target", "end_target")
        place = inside.select("uid", F.col("protein_id").alias("item_id"), "start", "end").distinct().join(target, "uid").where(F.col("_target").isNull() | (F.col("item_id") != F.col("_target")))
        rel = ((F.col("start") - F.col("start_target")) + (F.col("end") - F.col("end_target"))) / 2
        at = place.select(F.col("uid").alias("id"), "item_id", rel.alias("rel_pos")).join(prot.where("fam_cluster is not null").select(F.col("uid").alias("id"), F.col("id").alias("item_id"), F.col("fam_cluster").alias("item")), ["id", "item_id"])
        dist = trees.cosine_distance(cut(trees.position_weights(at.select("id", "item", "rel_pos")), "weights"))
    else:
        fill = "max"
        dist = trees.presence_jaccard(families_of)
    full = cut(trees.fill_distances(cut(dist, "distances"), leaves, fill), "filled")
    names = sorted(r[0] for r in leaves.collect())  # bounded by trees.MAX_LEAVES, which fill_distances checks
    if mode in ("neighborhood", "neighborhood_phylo"):
        return trees.single_linkage(names, trees.minimum_forest(full))
    return trees.tree(settings.tree_method, names, trees.matrix(names, full))
