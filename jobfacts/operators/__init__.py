"""DataFrame-in / DataFrame-out building blocks of the job fact."""
