"""Stages from raw feeds to result tables, and the configuration of the civic feeds."""
