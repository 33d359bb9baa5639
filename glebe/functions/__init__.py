"""Column functions: scalar rules, owner arrays, the one folding UDF."""

from glebe.functions.owners import explode_owners, owner_parts, with_owners
from glebe.functions.text import (
    clean_pct,
    cpf_extract,
    cpf_mask,
    digits_only,
    file_stem,
    fold_ci_ai,
    is_valid_lookup_key,
    mask_cpfs_in_text,
    owner_name,
    participation_pct,
    pct_rejects_file,
    py_strip,
    status_default,
    to_float,
    uf_from_file_name,
    uf_from_label,
)

__all__ = [
    "clean_pct", "cpf_extract", "cpf_mask", "digits_only", "explode_owners", "file_stem", "fold_ci_ai",
    "is_valid_lookup_key", "mask_cpfs_in_text", "owner_name", "owner_parts", "participation_pct",
    "pct_rejects_file", "py_strip", "status_default", "to_float", "uf_from_file_name", "uf_from_label",
    "with_owners",
]
