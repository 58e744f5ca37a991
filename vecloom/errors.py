"""Typed errors raised by the embedding jobs, one class per failure source."""


class EmbeddingError(Exception):
    """Base class: catch this to catch every error of the library."""


class ModelFileError(EmbeddingError):
    """A model folder or one of its files is missing or unreadable."""


class ModelNotConfiguredError(EmbeddingError):
    """No folder is configured for a model, and nothing is downloaded at run time."""


class ModelHeaderError(EmbeddingError):
    """The JSON header of a weight file cannot be parsed."""


class TokenizerError(EmbeddingError):
    """A tokenizer file is invalid, or a text cannot be tokenized for the model."""


class WeightsError(EmbeddingError):
    """A weight tensor is missing or has the wrong shape or type."""


class ModelTypeError(EmbeddingError):
    """The name asked for is not a model this library knows."""


class VectorError(EmbeddingError):
    """A vector has the wrong width, or a NULL among its elements."""
