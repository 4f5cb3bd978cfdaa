"""Language identification by compression.

For each language some slices of its training texts, normalised and joined, are the raw-content dictionary of a Zstandard
coder. A text is normalised the same way, cut into pieces of PIECE bytes, and each piece is compressed by itself with
every language's dictionary: the language with the smallest total is predicted, since its dictionary has the most of the
text's words. The margin is what the second best needs more, in bytes per byte of normalised text; a prediction whose
margin is below ``margin`` is rejected. Pieces keep the dictionary in reach over the whole of a long text.

Normalised means: lower-cased, with everything but letters and their marks turned into single spaces.

Training reads the text and the label of the training fold only. It takes at most SAMPLES slices of SLICE characters of
each of the LANGUAGES most frequent labels: slices are dealt by hash into SAMPLES buckets, and each bucket keeps one, so
that exact copies count once, every task keeps SAMPLES slices of a label at most, and the driver gets LANGUAGES * SAMPLES
of them.

Defined results: a null text and one without a letter get `und` with score 0; so does every text where nothing could be
learned. Of equal sizes the label that is more frequent in training wins, then the smaller one. Where one language is
learned, its rival is the coder without a dictionary. Labels of null and texts without a letter teach nothing; an empty
label is a label. Texts of any length are compressed whole; repeated rows are predicted alike; rows with a null id are in
the training fold; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from stratalake.functions.names import column
from stratalake.llm.common import bounded_batches, written
from stratalake.llm.toxicity import in_training

#: Bounds of the training sample.
LANGUAGES, SAMPLES, SLICE = 64, 256, 300
PIECE = 8192
#: Bytes saved per byte of text below which a prediction is rejected.
MARGIN = 0.01
UNKNOWN = "und"


def normalised(texts: pa.Array) -> pa.Array:
    """Lower-case words between single spaces; null is empty."""
    return pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")), r"[^\pL\pM]+", " ")


def coder(dictionary: bytes | None):
    """A Zstandard coder, with the raw content as its dictionary if there is one."""
    import zstandard

    setting = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_LAZY2, window_log=17, hash_log=15, chain_log=16, search_log=4, min_match=4, target_length=4,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    if not dictionary:
        return zstandard.ZstdCompressor(compression_params=setting)
    known = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(compression_params=setting)
    return zstandard.ZstdCompressor(compression_params=setting, dict_data=known)


@dataclass
class Model:
    """Dictionaries by language, the most frequent language first."""

    dictionaries: list[tuple[str, bytes]]
    margin: float = MARGIN
    coders: list = field(default_factory=list, repr=False, compare=False)

    def __getstate__(self):
        return {"dictionaries": self.dictionaries, "margin": self.margin, "coders": []}

    def sizes(self, plain: bytes) -> list[int]:
        """Compressed bytes of a normalised text by language."""
        if not self.coders:
            self.coders = [coder(d) for _, d in self.dictionaries] + [coder(None)]
        pieces = [plain[at : at + PIECE] for at in range(0, len(plain), PIECE)]
        used = self.coders[:-1] if len(self.dictionaries) > 1 else self.coders
        return [sum(len(c.compress(p)) for p in pieces) for c in used]

    def judged(self, plain: bytes) -> tuple[str, float]:
        """The language of a normalised text and the margin to the next."""
        if not self.dictionaries or not plain.strip():
            return UNKNOWN, 0.0
        sizes = self.sizes(plain)
        best = min(range(len(self.dictionaries)), key=sizes.__getitem__)
        rival = min(s for i, s in enumerate(sizes) if i != best)
        return self.dictionaries[best][0], max(0, rival - sizes[best]) / len(plain)


def learned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", languages: int = LANGUAGES, samples: int = SAMPLES, margin: float = MARGIN) -> Model:
    """A model of the training fold."""
    spark = docs.sparkSession
    text = column(text_col).cast("string")
    middle = F.greatest(F.lit(1), F.floor(F.char_length(text) / 2).cast("int") - SLICE // 2 + 1)
    rows = docs.filter(in_training(id_col) & column(lang_col).isNotNull() & text.isNotNull())
    rows = rows.select(column(lang_col).cast("string").alias("lang"), F.substring(text, middle, F.lit(SLICE)).alias("slice"))
    rows = rows.filter(F.col("slice").rlike(r"\p{L}")).withColumn("hash", F.xxhash64("slice"))
    bucket = F.pmod("hash", F.lit(samples)).alias("bucket")
    kept = rows.groupBy("lang", bucket).agg(F.count("*").alias("n"), F.min(F.struct("hash", "slice")).alias("least"))
    kept = written(kept, "language-slices")
    frequent = kept.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
    order = [r.lang for r in frequent.collect()]
    slices: dict[str, list[str]] = {lang: [] for lang in order}
    chosen = kept.join(F.broadcast(spark.createDataFrame([(lang,) for lang in order], "lang string")), "lang", "left_semi")
    for r in chosen.select("lang", "bucket", "least.slice").collect():
        slices[r.lang].append((r.bucket, r.slice))
    joined = {lang: " ".join(s for _, s in sorted(own)) for lang, own in slices.items()}
    return Model([(lang, normalised(pa.array([joined[lang]]))[0].as_py().encode()) for lang in order], margin)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang, best, margin, score`` of each row: ``best`` is the language of the smallest size, ``lang`` the same
    or `und` where the margin is too narrow, and the score margin / (margin + the model's), one half at the limit."""
    bounded_batches(docs.sparkSession)
    names = ["doc_id", "lang", "best", "margin", "score"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.judged(t.as_buffer().to_pybytes()) for t in normalised(batch.column(1))]
            best, margins = [f[0] for f in found], [f[1] for f in found]
            lang = [b if m >= model.margin else UNKNOWN for b, m in found]
            scores = [m / (m + model.margin) if m else 0.0 for m in margins]
            kinds = [pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (lang, best, margins, scores), kinds)], names)

    given = docs.select(column(id_col).alias("doc_id"), column(text_col).cast("string").alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(judge, f"doc_id {kind}, lang string, best string, margin double, score double")


def predict_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, accepted``: the language of the smallest size whatever the margin, and whether
    the margin is wide enough."""
    model = learned(docs, id_col, text_col, lang_col)
    found = identify(docs, model, id_col, text_col)
    return found.select("doc_id", (~in_training("doc_id")).alias("held_out"), F.col("best").alias("lang_pred"), "score", (F.col("lang") != UNKNOWN).alias("accepted"))
