"""Micro-batches: files that land are taken into a table once, whenever the job runs."""
