"""Training-data operators: one module per operator, their queries
(:mod:`.queries`) and SQL oracles (:mod:`.oracle`). Nothing outside this
subpackage imports it except the guarded hook in ``__spark_entry__``."""
