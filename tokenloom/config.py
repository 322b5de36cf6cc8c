"""Job settings. Plain frozen dataclasses, read once on the driver and baked into the plan."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from types import MappingProxyType

# Special tokens in id order (alias -> token text).
SPECIAL_TOKENS: Mapping[str, str] = MappingProxyType(
    {"<pad>": "[PAD]", "<unk>": "[UNK]", "<bos>": "[BOS]", "<eos>": "[EOS]"}
)

IGNORE_LABEL = -100


# The field names and defaults of the next three classes are fixed values: those of existing job files.
@dataclass(frozen=True)
class CleaningConfig:
    """A line is kept when ``min_length < length <= max_length`` (the lower bound is exclusive)."""

    remove_html: bool = True
    remove_special_chars: bool = True
    lowercase: bool = True
    min_length: int = 1
    max_length: int = 100_000


@dataclass(frozen=True)
class TokenizerConfig:
    """``dense_ids=False`` leaves a hole of one id per special-token alias before the alphabet."""

    vocab_size: int = 8192
    min_frequency: int = 2
    special_tokens: Mapping[str, str] = field(default_factory=lambda: dict(SPECIAL_TOKENS))
    max_token_length: int = 100
    lowercase: bool = False
    unicode_normalizer: str | None = "NFKC"
    dense_ids: bool = True


@dataclass(frozen=True)
class LoaderConfig:
    """``num_workers`` is the number of line shards; 0 and 1 both mean a single sequence."""

    batch_size: int = 8
    max_length: int = 256
    num_workers: int = 0
    shuffle_buffer_size: int = 1000
    pack_sequences: bool = True
    drop_last_block: bool = True
    seed: int = 0

    @property
    def shards(self) -> int:
        return max(1, self.num_workers)


@dataclass(frozen=True)
class JobConfig:
    cleaning: CleaningConfig = CleaningConfig()
    tokenizer: TokenizerConfig = TokenizerConfig()
    loader: LoaderConfig = LoaderConfig()
    train_path: str | None = None
    val_path: str | None = None


# Settings of existing job files that are about one machine's workers and have no meaning here.
IGNORED_LOADER_KEYS = frozenset({"prefetch_factor", "pin_memory", "persistent_workers", "shuffle"})
JOB_WORKERS = 4


def _settings(cls, section: str, values: Mapping | None, ignored: frozenset[str] = frozenset()) -> dict:
    """The given settings; a name that the section does not have is an error, not a silent default."""
    names = {f.name for f in fields(cls)}
    unknown = sorted(set(values or {}) - names - ignored)
    if unknown:
        raise ValueError(f"unknown settings in {section}: {', '.join(unknown)}")
    return {k: v for k, v in (values or {}).items() if k in names}


def load_job_config(source: str | Mapping) -> JobConfig:
    """Read the ``data`` and ``tokenizer`` sections of a YAML file (or an equal mapping).

    The vocabulary size may sit under ``tokenizer`` or, as in existing job files, under ``model``.
    Sections about model training are ignored, unknown settings in the others are an error. A job that names no number of
    workers has four.
    """
    if isinstance(source, Mapping):
        raw = source
    else:
        import yaml

        with open(source, encoding="utf-8") as f:
            raw = yaml.safe_load(f) or {}
    data = raw.get("data") or {}
    tokenizer = dict(raw.get("tokenizer") or {})
    if "vocab_size" in (raw.get("model") or {}):
        tokenizer.setdefault("vocab_size", raw["model"]["vocab_size"])
    return JobConfig(
        cleaning=CleaningConfig(**_settings(CleaningConfig, "data.cleaning", data.get("cleaning"))),
        tokenizer=TokenizerConfig(**_settings(TokenizerConfig, "tokenizer", tokenizer, frozenset({"type", "name"}))),
        loader=LoaderConfig(**{"num_workers": JOB_WORKERS} | _settings(LoaderConfig, "data.dataloader", data.get("dataloader"), IGNORED_LOADER_KEYS)),
        train_path=data.get("train_path"),
        val_path=data.get("val_path"),
    )
