"""Typed refusals: an operator raises one of these, naming the offenders, instead of dropping rows."""


class IsolakeError(Exception):
    """Base of all refusals."""


class ContractError(IsolakeError):
    """A table does not hold what its contract says."""


class DuplicateKeyError(ContractError):
    """A key that must be unique is not."""


class MismatchError(ContractError):
    """Two key sets that must be equal are not."""


class UnknownNameError(IsolakeError):
    """A column, operator or table of that name does not exist."""


class LimitError(IsolakeError):
    """A bound on the size of a computation is exceeded."""
