"""The registered queries and the SQL they are checked against."""

from . import audits, generated, logs, storage, transactions  # noqa: F401
from .catalog import REGISTRY  # noqa: F401
