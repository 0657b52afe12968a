"""Exceptions raised by the library."""


class KinfoldError(Exception):
    """Base of every error the library raises on purpose."""


class CollectionNotFound(KinfoldError):
    """The named collection does not exist."""


class CollectionExists(KinfoldError):
    """The named collection exists already."""


class ValidationError(KinfoldError, ValueError):
    """A record batch, a query vector or an argument breaks a rule of the data model."""


class FilterError(KinfoldError, ValueError):
    """A filter tree is malformed."""


class ConcurrentWrite(KinfoldError):
    """Another writer committed the same version first."""
