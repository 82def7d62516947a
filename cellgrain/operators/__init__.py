"""Lazy DataFrame operators over long-form tables: ``expr(cell_id, gene_id, value)`` without its zeros, ``cells`` and
``genes``. Nothing is collected but single rows and fitted models."""
