"""DataFrame -> DataFrame operators. None of them runs an action."""
