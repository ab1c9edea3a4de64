"""Reading what the pipeline starts from."""
