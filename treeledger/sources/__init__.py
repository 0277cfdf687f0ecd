"""Reading and writing mounted trees and node stores."""
