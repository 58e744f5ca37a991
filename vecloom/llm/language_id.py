"""Operator 10: language identification by compression.

Each language has a raw-content zstandard dictionary: pieces of its training texts. A text is
compressed in windows with every dictionary; the language whose dictionary makes it smallest
wins. The score is how much smaller the winner is than the next; where that margin is narrow
the text is `rejected`. Texts without a letter are `und`.

Training takes a bounded sample: at most `pieces` pieces of `piece_chars` characters for each
language (256 of 1,000 by default), of rows chosen by a hash of their text. They come to the
driver and go out as one broadcast of at most languages x pieces x piece_chars. Prediction is a
map over Arrow batches without a shuffle and uses nothing but the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from vecloom.llm.kept import release
from vecloom.session import ship_package

PIECES = 256
PIECE_CHARS = 1000
WINDOW_BYTES = 2048
LEVEL = 3
MARGIN = 0.005
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def train(rows: DataFrame, text: str = "text", lang: str = "lang", pieces: int = PIECES) -> dict[str, str]:
    """Language to dictionary content, of the rows that have both a text and a language.

    A bounded sample, alike at every size: of each language the rows whose text hashes lowest,
    each with one piece of PIECE_CHARS characters from a place given by that hash. A language's
    rows are cut to about four times `pieces` by a threshold on the hash before they are ranked,
    so no task ranks a whole language.
    """
    labelled = rows.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & (F.length(text) > 0))
    labelled = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return {}
    # Copies share a hash and count once, so the share of hashes is taken generously.
    share = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 8 * pieces / n))))
    unit = F.pmod("h", F.lit(1 << 30)) / float(1 << 30)
    few = labelled.where(unit <= share[F.col("lang")])
    place = 1 + F.pmod(F.shiftrightunsigned("h", 32), F.greatest(F.length("text") - PIECE_CHARS + 1, F.lit(1)))
    few = few.select("lang", "h", F.substring("text", place.cast("int"), F.lit(PIECE_CHARS)).alias("piece"))
    few = few.dropDuplicates(["lang", "h"])
    best = few.groupBy("lang").agg(F.slice(F.sort_array(F.collect_list(F.struct("h", "piece"))), 1, pieces).alias("s"))
    return {r["lang"]: "\n".join(x["piece"] for x in r["s"]) for r in best.collect()}


class _Classifier:
    def __init__(self, contents: dict[str, str]):
        self.by_lang = []
        for lang in sorted(contents):
            data = contents[lang].lower().encode("utf-8")
            book = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            book.precompute_compress(level=LEVEL)
            made = zstandard.ZstdCompressor(
                level=LEVEL, dict_data=book, write_checksum=False, write_content_size=False, write_dict_id=False
            )
            self.by_lang.append((lang, made))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score from 0 to 1); ties go to the first language by name."""
        if not text or not _LETTER.search(text) or not self.by_lang:
            return UNKNOWN, 0.0
        data = memoryview(text.lower().encode("utf-8"))
        windows = [data[i : i + WINDOW_BYTES] for i in range(0, len(data), WINDOW_BYTES)]
        sizes = [(sum(len(c.compress(w)) for w in windows), lang) for lang, c in self.by_lang]
        sizes.sort()
        if len(sizes) == 1:
            return sizes[0][1], 1.0
        return sizes[0][1], 1.0 - sizes[0][0] / sizes[1][0]


ADDED = ("lang_pred", "score", "rejected")


def identify(
    docs: DataFrame,
    contents: dict[str, str],
    text: str = "text",
    margin: float = MARGIN,
    names: dict[str, str] | None = None,
) -> DataFrame:
    """`docs` with `lang_pred string`, `score double` (0 to 1) and `rejected boolean`.

    Whole texts are compressed, in windows of WINDOW_BYTES. `rejected` holds where the score is
    under `margin` and where there is no language (`und`: NULL, empty, no letter, or nothing
    learned). All columns stay; `names` gives other names to the added ones where the table has them
    already, which is an error.
    """
    added = [(names or {}).get(name, name) for name in ADDED]
    clash = set(added) & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already; choose other output names")
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(contents)
    schema = StructType(
        [
            *docs.schema.fields,
            *(StructField(name, kind) for name, kind in zip(added, (StringType(), DoubleType(), BooleanType()), strict=True)),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        classifier = _Classifier(shared.value)
        for batch in batches:
            found = [classifier.predict(t.as_py()) for t in batch[text]]
            langs, scores = [f[0] for f in found], [f[1] for f in found]
            more = [
                pa.array(langs, pa.string()),
                pa.array(scores, pa.float64()),
                pa.array([s < margin or x == UNKNOWN for x, s in found], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *added])

    return docs.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """Rows kept from training: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))
