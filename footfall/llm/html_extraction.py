"""HTML extraction: the article of a page by a conditional random field over its leaf blocks.

The model is learned on the driver from a fixed number of labelled pages (``block_crf``) and goes
to the tasks with the code: some thousand weights. Pages are parsed and decoded in tasks, each
row on its own, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.block_crf import Labeller, Model, train
from footfall.llm.html_blocks import leaf_blocks
from footfall.llm.shared import unused, whole_text


@lru_cache(maxsize=1)
def default_model() -> Model:
    return train()


def main_text(html: str, labeller: Labeller) -> str:
    """The texts of the page's article blocks, a line each."""
    blocks = leaf_blocks(html)
    return "\n".join(b.text for b, label in zip(blocks, labeller.labels(blocks)) if label)


def extract(pages: DataFrame, html: str = "html", model: Model | None = None) -> DataFrame:
    """``pages`` with ``text``, the article's text, and ``n_chars``, its code points.

    White space inside a block is one space, blocks stand on lines of their own, character
    references are decoded. Null, empty and text-free pages, and pages without an article, give an
    empty text. A long page is parsed whole. Rows are judged one by one, so repeated rows get equal
    answers and an empty table stays empty. ``text`` and ``n_chars`` replace columns of these names.
    """
    model, found = model or default_model(), unused(pages, "_found")

    @F.pandas_udf("string")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        labeller = Labeller(model)
        for batch in batches:
            yield batch.map(lambda page: main_text(page, labeller))

    rows = pages.withColumn(found, read(whole_text(html)))
    return rows.withColumns({"text": F.col(found), "n_chars": F.char_length(found).cast("long")}).drop(found)
