"""Operators for preparing text corpora; `registry` lists their queries."""
