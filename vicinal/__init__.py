"""Vector tables and similarity search as Spark DataFrame jobs."""

from vicinal.options import IVF, IVFPQ, IVFFlat
from vicinal.plans.index import VectorIndex, VectorStore

__all__ = ["IVF", "IVFFlat", "IVFPQ", "VectorIndex", "VectorStore"]
