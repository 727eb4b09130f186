"""Which of many names stand in which texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitmill.plans.staging import SMALL


def _blocks(text: Column, least: int | None) -> Column:
    """What a name and a text that holds it both have: words and pairs of neighbouring words, or runs of ``least`` characters; of the text."""
    if least is None:
        words = F.filter(F.split(text, " "), lambda w: w != "")
        pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))
        return F.array_distinct(F.concat(words, pairs))
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - (least - 1), F.lit(1))), lambda k: F.substring(text, k, F.lit(least)))
    return F.array_distinct(runs)


def _block(name: Column, least: int | None) -> Column:
    """A name's block: its first two words (one, for a name of one), or first ``least`` characters."""
    if least is not None:
        return F.substring(name, 1, least)
    words = F.filter(F.split(name, " "), lambda w: w != "")
    return F.array_join(F.slice(words, 1, 2), " ")


def names_within(texts: DataFrame, id_col: str, text_col: str, names: DataFrame, name_col: str = "name", least: int | None = None, small: int = SMALL) -> DataFrame:
    """``(id, name)`` of every distinct name in a text: on word bounds (words parted by one space), or with ``least`` anywhere, for names of at least so many characters.

    Names of at most ``small`` bytes together go to every task, which looks the blocks of a text up in them and verifies what it finds, so that
    texts stay where they are. Beyond, the blocks of texts and names meet, with ids only, and the texts of those that met are
    looked at again; a text is never copied for a block.
    """
    listed = names.select(F.col(name_col).alias("name")).where("name <> ''").distinct()
    if least is not None:
        listed = listed.where(F.length("name") >= least)
    kind = dict(texts.dtypes)[id_col]
    rows = texts.select(F.col(id_col).alias("id_"), F.col(text_col).alias("text_"))
    size = listed.agg(F.sum(F.octet_length("name") + 16).alias("n")).first()["n"] or 0
    if size <= small:
        held = texts.sparkSession.sparkContext.broadcast(_by_block([r["name"] for r in listed.collect()], least))  # at most ``small`` bytes of names

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blocks = held.value
            known = blocks.keys()
            for batch in batches:
                own, found = [], []
                for k, text in enumerate(batch.column(1).to_pylist()):
                    if text is None:  # a condition before this would make the texts, which may be long expressions, twice
                        continue
                    if least is None:
                        words = [w for w in text.split(" ") if w]
                        met = known & set(words) | known & {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}
                        whole = f" {' '.join(words)} "
                        hits = [n for b in met for n in blocks[b] if f" {n} " in whole]
                    else:
                        met = known & {text[i : i + least] for i in range(len(text) - least + 1)}
                        hits = [n for b in met for n in blocks[b] if n in text]
                    own += [k] * len(hits)
                    found += hits
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own, pa.int64())), pa.array(found, pa.string())], [id_col, "name"])

        return rows.mapInArrow(run, f"`{id_col}` {kind}, name string")
    rows = rows.where("text_ is not null")
    met = rows.select("id_", F.explode(_blocks(F.col("text_"), least)).alias("block_")).join(listed.withColumn("block_", _block(F.col("name"), least)), "block_").select("id_", "name").distinct()
    both = met.join(rows, "id_")
    inside = F.contains("text_", "name") if least is not None else F.contains(F.concat(F.lit(" "), "text_", F.lit(" ")), F.concat(F.lit(" "), "name", F.lit(" ")))
    return both.where(inside).select(F.col("id_").alias(id_col), "name")


def _by_block(names: list[str], least: int | None) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for name in names:
        block = name[:least] if least is not None else " ".join([w for w in name.split(" ") if w][:2])
        out.setdefault(block, []).append(name)
    return out
