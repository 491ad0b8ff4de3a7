"""Relational operators of the attention-decay models; each takes DataFrames and returns one."""
