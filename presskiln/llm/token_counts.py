"""Token counts by proof: pre-tokens that are one token are counted, only the rest are merged."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from presskiln.llm.common import releasing, ship
from presskiln.llm.tokens import Cache, encoder

# Fixed value: the character that stands for a blank in the vocabulary.
BLANK = "▁"
LIMIT = 4096


class PieceCounter:
    """Counts tokens of whole texts as a sentencepiece BPE model gives them.

    A pre-token is a run of blanks and the characters up to the next run. Two facts are proved
    from the model file when the counter is made: no piece of the vocabulary has a blank behind
    another character, and there are no user-defined pieces, so no merge crosses the border of two
    pre-tokens and each is encoded alone; and the model neither rewrites characters nor drops
    blanks. A model without these properties is refused. Then every piece that begins with one
    blank is encoded alone: those that stay one token count as one wherever they are a pre-token.
    """

    _runs = re.compile(" +[^ ]*")

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as model_pb2

        model = model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules = model.normalizer_spec
        plain = not rules.precompiled_charsmap and rules.add_dummy_prefix and not rules.remove_extra_whitespaces
        inner = any(re.search(f"[^{BLANK}]{BLANK}", p.piece) for p in model.pieces)
        if not plain or inner or rules.normalization_rule_tsv or any(p.type == 4 for p in model.pieces):
            raise ValueError("pre-tokens of this model do not encode alone")
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        words = [p.piece[1:] for p in model.pieces if p.type == 1 and p.piece[0] == BLANK and p.piece[1:2] not in ("", BLANK)]
        encoded = self.library.encode(words, num_threads=1)
        self.whole = frozenset(w for w, ids in zip(words, encoded, strict=True) if len(ids) == 1)
        known = self.library.piece_to_id(BLANK) != self.library.unk_id()
        self.blank = 1 if known else len(BLANK.encode())  # a lone blank, else its bytes
        self.rest = Cache(self._merge)

    def _merge(self, word: str) -> int:
        """Tokens of a pre-token without its first blank, which the library puts in front."""
        if word in self.whole:
            return 1
        return len(self.library.encode(word)) if word else self.blank

    def count(self, text: str) -> int:
        if not text:
            return 0
        if BLANK in text:
            text = text.replace(BLANK, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            words = [run[1:] for run in self._runs.findall(" " + text)]
        else:
            words = text.split(" ")
        return sum(map(self.rest.__getitem__, words))


def count_tokens(docs: DataFrame, model: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of (doc_id, text).

    One pass without a shuffle. Null and empty texts have 0 bytes and 0 tokens; repeated rows
    give repeated rows; a null doc_id stays null; other columns are not read.
    """
    ship(docs.sparkSession)

    def count(batches):
        counter = encoder(PieceCounter, model)
        for batch in batches:
            sizes, tokens = [], []
            for text in batch["text"]:
                text = text.as_py() or ""
                sizes.append(len(text.encode()))
                tokens.append(counter.count(text))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select("doc_id", "text").mapInArrow(releasing(count, "encoders"), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
