"""DataFrame in, DataFrame out: nothing here triggers a job."""
