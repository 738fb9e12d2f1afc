"""Typed errors."""


class GraphError(Exception):
    """Any error of the engine."""


class NotFoundError(GraphError):
    """A vertex, edge, label or argument that is needed isn't there."""


class SchemaError(GraphError, ValueError):
    """A schema or data that contradicts it."""


class ParseError(GraphError, ValueError):
    """Text that isn't what it should be."""
