"""All checked queries. Importing this module registers them."""

from pushlake.plans import (  # noqa: F401
    q_agg,
    q_cells,
    q_funcs,
    q_io,
    q_ordered,
    q_parse,
    q_stream,
)
