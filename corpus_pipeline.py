"""Corpus pipeline: from documents to packed sequences in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of
``docs``, except the last, which returns the pieces of packed sequences. What a
stage returns is written as Parquet and read back as the next one's docs.

1. quality       documents that the quality classifier rejects go
2. exact_dedup   of equal texts (white space aside) one row stays
3. near_dedup    of each class of near-duplicates one row stays
4. suffix_dedup  byte strings of 400 and more that occur elsewhere are cut out
5. packing       what is left is encoded and packed into sequences of 2048 tokens

Defined cases: null text counts as empty in every stage, and empty texts are equal, so one row of them stays if the
classifier keeps them; repeated rows and repeated or null ids are rows of their own until exact_dedup, which keeps one row
of each text (most characters, then smallest id, null last); very long texts are worked on whole, and cut into pieces by
packing alone; a document whose text is cut empty stays and is packed as its closing id; other columns, also with names
that the operators use themselves, go through unchanged; an empty table gives empty stages and no sequences.
"""

from lexcurate.llm import common, exact_dedup, minhash, packing, quality, suffix_dedup

#: No SQL: the classifier and the tokenizer can't be expressed; tests compare the stages with brute force.
ORACLE_SQL = None


#: Scratch tables of the last stage that ran. Its result is written out before the next stage begins.
_PREVIOUS = []


def _stage(make):
    """A stage that deletes what the stage before it left in the scratch folder."""

    def stage(spark, docs, sf_dir):
        common.configure(spark)
        if not any("/llm-" in path for path in docs.inputFiles()):  # else docs still reads it
            for folder in _PREVIOUS:
                common.delete(*folder)
        _PREVIOUS.clear()
        out, left = common.made_by(lambda: make(spark, docs, sf_dir))
        if make is not pack:  # the last result is the caller's, to be read when it likes
            _PREVIOUS.extend(left)
        return out

    return stage


def keep_good(spark, docs, sf_dir):
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_one_exact(spark, docs, sf_dir):
    return exact_dedup.keep_one(docs)


def keep_one_near(spark, docs, sf_dir):
    return minhash.keep_one(docs)


def cut_repeats(spark, docs, sf_dir):
    return suffix_dedup.without_repeats(docs)


def pack(spark, docs, sf_dir):
    return packing.pack(docs)


STAGES = [("quality", _stage(keep_good)), ("exact_dedup", _stage(keep_one_exact)), ("near_dedup", _stage(keep_one_near)),
          ("suffix_dedup", _stage(cut_repeats)), ("packing", _stage(pack))]


def run(spark, sf_dir):
    """All stages over ``documents``. Tables between stages lie in the folder of spark.checkpoint.dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = common.stage_path(spark, name)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
