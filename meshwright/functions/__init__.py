"""See the package README section of the repository."""
