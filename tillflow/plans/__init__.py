"""Business queries over star-schema frames.

Every query takes frames, so the caller chooses between one batch and the stored
tables. All of them sum up the fact by its foreign key before joining a
dimension: a key with a third of all rows then reaches the join as one row, and
the join needs no more than the shuffle of the sum. The names are grouped again
behind the join without another shuffle, which keeps the meaning of a join with
a dimension that repeats a key.
"""
