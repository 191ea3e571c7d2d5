"""Training-data operators: one module per operator, each with its own general
interface; the checked queries are in ``queries.py``. Nothing else in the library
imports this subpackage."""
