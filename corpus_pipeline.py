"""Corpus pipeline: language filter, near duplicates, repeated passages,
benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; every one but the last returns the columns it was given.

* ``language_id`` drops texts without a language (null, or no letter) and texts
  of which less than ``MIN_SHARE`` of the n-grams are in the predicted
  language's filter (junk); everything else stays.
* ``near_duplicates`` keeps one document of each group: the one with the
  smallest id (null ids last); of equal rows one.
* ``repeats`` cuts strings of more than ``PASSAGE`` words that occur elsewhere,
  however short the words, and strings of ``PASSAGE_BYTES`` bytes, which have
  fewer words where those are long or not set apart by blanks.  A character cut
  in two goes as a whole.  Documents stay, even empty.
* ``decontaminate`` drops documents that hold a benchmark passage: half of an
  item, or the whole of one with fewer than ``WHOLE_BELOW`` words.
* ``packing`` returns the pieces of the packed sequences.

Edge cases: a row without text leaves at the first stage, one without words
passes the others; a null id is an id like others; of equal rows one stays; an
empty table gives no row; very long texts are worked on whole; columns beyond
those of ``documents`` are carried along.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import jaccard, lang_id, leaks, packing, repeats
from tidemark.llm.common import materialise, ship, table

MIN_SHARE = 0.2
#: Words a shingle of the near-duplicate stage, and the similarity from which two texts are near.
SHINGLE, SIMILAR = 5, (80, 100)
#: A repeated passage has more words than this, or this many bytes.
PASSAGE, PASSAGE_BYTES = 50, 400
#: Benchmark items of fewer words are leaked only as a whole.
WHOLE_BELOW = 5


def language_id(spark, docs, sf_dir):
    ship(spark)
    model = lang_id.learn(docs.where(~lang_id.held_out()))
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("rec"), F.col("text").alias("text"))
    kept = lang_id.identify(rows, model).where(f"lang_pred <> 'und' and score >= {MIN_SHARE}")
    return kept.select(*[F.col(f"rec.`{c}`").alias(c) for c in docs.columns])


def near_duplicates(spark, docs, sf_dir):
    ship(spark)
    columns = docs.columns
    labels = jaccard.link_components(docs, n=SHINGLE, num=SIMILAR[0], den=SIMILAR[1])
    # Nulls are skipped by the hash, so each column's null goes in as a flag.
    cells = [x for c in columns for x in (docs[f"`{c}`"], docs[f"`{c}`"].isNull())]
    digest = {"h1": F.xxhash64(*cells), "h2": F.xxhash64(F.lit(7), *cells)}
    slim = docs.select(F.struct(docs["doc_id"].alias("id"), *[v.alias(k) for k, v in digest.items()]).alias("rec"),
                       F.col("text").alias("text"))
    mark = F.struct(F.col("rec.id").isNull().alias("z"), F.col("rec.id").alias("id"), "rec.h1", "rec.h2")
    # One mark a set first, so a set that any number of rows have is a row a task.
    best = (jaccard.named_sets(slim, SHINGLE).where("size > 0")
            .groupBy(F.struct("s1", "s2").alias("node")).agg(F.min(mark).alias("mark"))
            .join(labels, "node", "left").groupBy(F.coalesce("comp", "node").alias("group"))
            .agg(F.min("mark").alias("mark")).select("mark.h1", "mark.h2"))
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in columns]).alias("rec"),
                       F.coalesce(docs["text"], F.lit("")).rlike(r"[^\x20\x09-\x0D]").alias("has_words"),
                       *[v.alias(k) for k, v in digest.items()])
    chosen = rows.where("has_words").join(best, ["h1", "h2"], "left_semi").dropDuplicates(["h1", "h2"])  # equal rows
    return (chosen.select("rec").union(rows.where("not has_words").select("rec"))
            .select(*[F.col(f"rec.`{c}`").alias(c) for c in columns]))


def repeated_passages(spark, docs, sf_dir):
    ship(spark)
    columns = docs.columns
    rest = F.struct(*[docs[f"`{c}`"] for c in columns if c.lower() != "text"])
    rows = docs.select(F.struct(docs["text"].isNull().alias("none"), rest.alias("rest")).alias("rec"),
                       F.col("text").alias("text"))
    cut = repeats.remove_repeats(rows, length=PASSAGE_BYTES, keep=["rec"], whole_characters=True, over_words=PASSAGE)
    text = F.when(~F.col("rec.none"), F.col("kept").cast("string"))
    return cut.select(*[text.alias(c) if c.lower() == "text" else F.col(f"rec.rest.`{c}`").alias(c) for c in columns])


def decontaminate(spark, docs, sf_dir):
    ship(spark)
    return leaks.without_leaks(docs, table(spark, sf_dir, "benchmark"), whole_below=WHOLE_BELOW)


def pack(spark, docs, sf_dir):
    ship(spark)
    return packing.pack(docs, keep=["doc_id"])


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("repeats", repeated_passages),
          ("decontaminate", decontaminate), ("packing", pack)]

#: Tokenisers, alignment and Bloom filters are beyond SQL; the tests compare
#: every stage with a brute-force version instead.
ORACLE_SQL = None


def run(spark, sf_dir: str):
    """Apply the stages to ``documents``, each one's rows written and reread."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{name}")
    return docs
