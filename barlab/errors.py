"""The one error raised when an input table does not fit an operator."""


class DataValidationError(ValueError):
    """A table lacks required columns or rows."""
