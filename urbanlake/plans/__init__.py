"""Staging, report and pipeline plans."""
