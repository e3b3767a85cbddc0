"""Complete jobs: from weather tables to capacity factors and their aggregates."""
