"""Cutline: a medallion analytics library for seat-allotment lists, written as Spark DataFrame jobs."""
