"""Token counts: pieces of text that are whole tokens are counted directly, only the rest is merged."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField

from tidelog.llm.pretokens import Pieces, load
from tidelog.llm.texts import map_texts


def whole_tokens(path: str) -> list[str]:
    """The strings of the vocabulary that the tokenizer, given them alone, encodes as one token: proved one by one.

    Their number is bounded by the vocabulary.
    """
    tokenizer = load(path)
    names = [tokenizer.decode([i], skip_special_tokens=False) for i in range(tokenizer.get_vocab_size(with_added_tokens=False))]
    added = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    names = sorted({n for n in names if n and n not in added and "�" not in n})
    made = tokenizer.encode_batch(names, add_special_tokens=False)
    return [n for n, m in zip(names, made) if len(m.ids) == 1]


def count_tokens(docs: DataFrame, text: str, keep: list[str], path: str) -> DataFrame:
    """Columns ``row`` (of ``keep``) and ``n_tokens``: what the byte-level tokenizer at ``path`` makes of the text.

    The file has to be there on every executor. Special strings in a text are the tokens they name, as in the
    library; nothing is added, cut or filled up. Null and empty texts have 0 tokens.
    """
    sent = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))
    worker: dict[str, Pieces] = {}  # one for each worker, kept over batches

    def compute(texts: pa.Array) -> list[pa.Array]:
        if path not in worker:
            worker[path] = Pieces(path, words=False, whole=sent.value)
        return [pa.array(worker[path].counts(texts))]

    return map_texts(docs, text, keep, [StructField("n_tokens", LongType())], compute)

