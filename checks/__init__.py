"""SQL oracles of the registered queries; not part of the shipped package."""
