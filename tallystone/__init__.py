"""Tallystone: file-catalogue analytics on PySpark."""
