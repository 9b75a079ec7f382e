"""Problem 7: encoding of a whole corpus with a public tokenizer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.llm import bpe


def encode_texts(df: DataFrame, id_col: str, text_col: str, vocab: str = bpe.DEFAULT_VOCAB) -> DataFrame:
    """(id, ids): the token ids of each row's text, without special tokens.

    The method is that of :mod:`paperloom.llm.bpe`: an Aho-Corasick automaton over the Latin-1 image of the bytes and
    backtracking from longest matches. It is a map without shuffle; other columns of ``df`` are never read.

    Defined cases: an empty and a null text have the empty list (never null); every input row gives one output row,
    repeated ids too; special-token strings inside a text are ordinary text; the length of a text is not limited;
    an empty table gives an empty result.
    """
    schema = T.StructType([df.select(F.col(id_col)).schema[0], T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])

    def run(batches):
        import array

        import numpy as np
        import pyarrow as pa

        enc = bpe.encoder(vocab)
        for b in batches:
            # short runs of rows keep the flat arrays small however long the texts are
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                flat, ends = array.array("i"), [0]
                for text in part.column(1).to_pylist():
                    flat.extend(enc.encode(text))
                    ends.append(len(flat))
                ids = pa.ListArray.from_arrays(pa.array(np.array(ends, "int32")), pa.array(np.frombuffer(flat, "int32") if flat else np.zeros(0, "int32")))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], [id_col, "ids"])

    return df.select(F.col(id_col), F.col(text_col).alias("__text")).mapInArrow(run, schema)


def count_tokens(df: DataFrame, id_col: str, text_col: str, vocab: str = bpe.DEFAULT_VOCAB) -> DataFrame:
    """(id, n_tokens): the length of each row's encoding; null and empty texts have 0."""
    schema = T.StructType([df.select(F.col(id_col)).schema[0], T.StructField("n_tokens", T.LongType(), False)])

    def run(batches):
        import pyarrow as pa

        enc = bpe.encoder(vocab)
        for b in batches:
            n = [enc.count(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], [id_col, "n_tokens"])

    return df.select(F.col(id_col), F.col(text_col).alias("__text")).mapInArrow(run, schema)
