"""Conversation and long-form text analytics on Spark DataFrames."""
