"""Corpus preparation for language models as PySpark DataFrame jobs."""

import sys

from pyspark import cloudpickle

from tokenloom.config import CleaningConfig, JobConfig, LoaderConfig, TokenizerConfig, load_job_config
from tokenloom.operators.vocabulary import Tokenizer, TokenizerError

__all__ = [
    "CleaningConfig",
    "JobConfig",
    "LoaderConfig",
    "Tokenizer",
    "TokenizerConfig",
    "TokenizerError",
    "load_job_config",
]

# Functions that run in tasks travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
