from lodestrata.functions.keys import (  # noqa: F401
    hash_key, hashdiff, key_rules, link_key, norm, parent_key, row_digest, zero_key,
)
