"""forkline: signed change logs of reorganisable event chains, on Spark.

Blocks, transactions, logs and storage changes arrive as nested commit / revert /
reorg notifications.  They are flattened into append-only tables whose ``sign``
column is +1 for a commit and -1 for a revert, collapsed into the current state,
and queried with DataFrame-in, DataFrame-out operators.
"""
