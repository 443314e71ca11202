"""DataFrame-to-DataFrame steps: profile, clean, aggregate, check, star, report."""
