"""Text embedding and vector retrieval on Spark."""

from vecloom.functions.registry import register, register_vector_functions
from vecloom.operators.cells import build_cells, calibrate_cells, fit_centroids, topk_cells
from vecloom.operators.embed import embed_column, tokenize_column
from vecloom.operators.hashing import embed_hash
from vecloom.operators.lsh import lsh_join
from vecloom.operators.topk import topk, topk_batch
from vecloom.plans.retrieval import ask, retrieve
from vecloom.session import get_session
from vecloom.sources.chunks import read_chunks
from vecloom.sources.tables import build_vector_table
from vecloom.streaming.embed_stream import embed_stream

__all__ = [
    "ask",
    "build_cells",
    "build_vector_table",
    "calibrate_cells",
    "embed_column",
    "embed_hash",
    "embed_stream",
    "fit_centroids",
    "get_session",
    "lsh_join",
    "read_chunks",
    "register",
    "register_vector_functions",
    "retrieve",
    "tokenize_column",
    "topk",
    "topk_batch",
    "topk_cells",
]
